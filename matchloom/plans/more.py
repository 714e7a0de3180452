"""Queries on cleaning, lookups, registers, metadata and prices, and their SQL where SQL expresses it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixture import matches
from ..functions import scalars as S
from ..functions.similarity import player_key, ratio_percent
from ..operators import backtest, linkage, odds, rating, registry, resolve, tables
from ..operators.events import player_events
from ..sources.store import match_stats
from .catalog import _E, _M, _bets, _read, _rounded, query

FIRST = ("Ann", "Ben", "Cy", "Dan", "Eve", "Flo", "Guy", "Hal")
LAST = ("Abel", "Brook", "Crane", "Drake", "Ellis", "Frost", "Grant", "Hobbs", "Irwin", "Jonas", "Keller", "Lowe")


def _name(id_: Column) -> Column:
    pick = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n + 1).cast("int"))
    return F.concat_ws(" ", pick(FIRST, id_ % len(FIRST)), pick(LAST, id_ % len(LAST)))


# ---- lookups


@query(f"""WITH {_M}, c AS (SELECT n_nationkey AS k, n_name FROM nation) SELECT seq, tourney_id, n_name AS tourney_name FROM m LEFT JOIN c ON k = tourney_id - 1990""")
def join_calendar(spark, sf_dir):
    """Matches with their tournament's name, where the calendar has one."""
    c = _read(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1990).cast("int").alias("tourney_id"), "n_name")
    return linkage.lookup(matches(spark, sf_dir), c, ["tourney_id"], {"n_name": "tourney_name"}).select("seq", "tourney_id", "tourney_name")


@query(f"""WITH {_M}, s AS (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q FROM lineitem GROUP BY ALL) SELECT seq, CAST(seq % 3 + 1 AS INT) AS line, CAST(q AS DOUBLE) AS quantity FROM m LEFT JOIN s ON l_orderkey = seq AND l_linenumber = seq % 3 + 1""")
def join_composite(spark, sf_dir):
    """Matches with a statistic of two keys."""
    li = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("seq"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_quantity").cast("double").alias("quantity"))
    return linkage.lookup(matches(spark, sf_dir).select("seq", (F.col("seq") % 3 + 1).cast("int").alias("line")), li, ["seq", "line"])


@query("""SELECT c_custkey AS k, CAST(arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS BIGINT) AS last_order, CAST(max(o_orderdate) AS DATE) AS last_date FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def join_latest(spark, sf_dir):
    """Every customer with the newest of its rows."""
    o = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("last_date"), F.col("o_orderkey").cast("long").alias("last_order"))
    return linkage.lookup(_read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), linkage.latest(o, ["k"], ["last_date", "last_order"]), ["k"])


@query("""SELECT o_orderkey AS k, CAST(coalesce(CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 100000 END, o_custkey) AS BIGINT) AS player_id FROM orders""")
def join_remap(spark, sf_dir):
    """Identifiers replaced where a table has a new one; the others stay."""
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("long").alias("player_id"), F.col("o_custkey").alias("old"))
    new = _read(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") + 100000).cast("long").alias("new"))
    ids = _read(spark, sf_dir, "orders").filter("o_custkey % 3 = 0").select(F.col("o_custkey").alias("old"), (F.col("o_custkey") + 100000).cast("long").alias("new"))
    return linkage.lookup(o, new.union(ids).distinct(), ["old"], {"new": "player_id"}).select("k", "player_id")


@query(f"""WITH {_E}, r AS (SELECT player_id, opponent_id, seq, tourney_date, round, row_number() OVER (PARTITION BY player_id ORDER BY tourney_date DESC, seq DESC) AS n FROM e)
SELECT player_id, tourney_date AS date, seq AS match_id, 'p' || opponent_id AS opponent, round FROM r WHERE n = 1""")
def recent_matches(spark, sf_dir):
    """Every player's last match and opponent."""
    m = matches(spark, sf_dir).select(F.col("seq").alias("match_id"), F.col("tourney_date").alias("date"), "round", "player1_id", "player2_id", *[F.concat(F.lit("p"), F.col(f"player{p}_id").cast("string")).alias(f"player{p}_name") for p in (1, 2)])
    return linkage.recent_matches(m).select("player_id", "date", "match_id", "opponent", "round")


# ---- cleaning


@query(f"""WITH {_M}, x AS (SELECT seq, CASE WHEN seq % 5 = 0 THEN NULL ELSE p1_ace END AS a, CASE WHEN seq % 3 = 0 THEN NULL ELSE p2_ace END AS b FROM m)
SELECT seq, (a IS NOT NULL AND b IS NOT NULL) AS whole FROM x WHERE a IS NOT NULL OR b IS NOT NULL""")
def drop_missing(spark, sf_dir):
    """Rows that lack all of two cells go; whether they lack any."""
    m = matches(spark, sf_dir).select("seq", F.when(F.col("seq") % 5 != 0, F.col("p1_ace")).alias("a"), F.when(F.col("seq") % 3 != 0, F.col("p2_ace")).alias("b"))
    whole = tables.drop_missing(m, ["a", "b"]).select("seq", F.lit(True).alias("w"))
    return tables.drop_missing(m, ["a", "b"], "all").join(whole, "seq", "left").select("seq", F.coalesce("w", F.lit(False)).alias("whole"))


_DOUBLES = "CASE WHEN seq % 11 = 0 THEN 'A, B' WHEN seq % 7 = 0 THEN NULL WHEN seq % 5 = 0 THEN ' ' ELSE 'A' END"


@query(f"""WITH {_M}, x AS (SELECT seq, round, {_DOUBLES} AS n FROM m) SELECT seq, nullif(trim(n), '') AS name FROM x WHERE round <> 'ER' AND (n IS NULL OR NOT contains(n, ',')) AND seq <> (SELECT min(seq) FROM x WHERE round = 'F' AND (n IS NULL OR NOT contains(n, ',')))""")
def clean_rows(spark, sf_dir):
    """Doubles and early rounds go, blanks become null, and the first final goes."""
    s = F.col("seq")
    m = matches(spark, sf_dir).select("seq", "round", F.lit("Open").alias("tourney_name"), F.when(s % 11 == 0, "A, B").when(s % 7 == 0, None).when(s % 5 == 0, " ").otherwise("A").alias("name"))
    out = tables.drop_first(tables.blanks_to_null(tables.singles_only(m, ["name"])), F.col("round") == "F", ["seq"])
    return out.select("seq", "name")


@query(f"""WITH {_M} SELECT seq, CAST(p2_bpFaced - p2_bpSaved AS BIGINT) AS p1_bpconv, CAST(p1_bpFaced - p1_bpSaved AS BIGINT) AS p2_bpconv, CASE WHEN p2_SvGms <> 0 THEN round(p2_bpFaced / p2_SvGms, 6) END AS p1_bp_rg,
  CAST("p1_1stWon" + "p1_2ndWon" + p2_svpt - "p2_1stWon" - "p2_2ndWon" AS BIGINT) AS p1_tpw, CAST(p1_set1 + p1_set2 + p1_set3 AS INT) AS p1_sw FROM m""")
def derived_stats(spark, sf_dir):
    return _rounded(tables.derived_stats(matches(spark, sf_dir)).select("seq", "p1_bpconv", "p2_bpconv", "p1_bp_rg", "p1_tpw", "p1_sw"), ["p1_bp_rg"])


_NAMES = "CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN p_name || '7' ELSE p_name || ' ' || chr(CAST(97 + p_partkey % 26 AS INT)) || chr(CAST(97 + p_partkey // 26 % 26 AS INT)) END"


@query(f"""WITH x AS (SELECT p_partkey AS k, {_NAMES} AS name FROM part), n AS (SELECT name FROM x WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1)
SELECT k, name, CASE WHEN name IS NULL THEN 'null' WHEN NOT regexp_full_match(name, '[\\p{{L}} \\-''.]+') THEN 'irregular' ELSE 'repeated' END AS problem FROM x WHERE name IS NULL OR NOT regexp_full_match(name, '[\\p{{L}} \\-''.]+') OR name IN (SELECT name FROM n)""")
def irregular_names(spark, sf_dir):
    k = F.col("p_partkey")
    letter = lambda n: F.char((97 + n % 26).cast("long"))
    name = F.when(k % 9 == 0, None).when(k % 9 == 1, F.concat("p_name", F.lit("7"))).otherwise(F.concat("p_name", F.lit(" "), letter(k), letter(F.floor(k / 26))))
    return tables.irregular_names(_read(spark, sf_dir, "part").select(k.alias("k"), name.alias("name")), "name")


@query(f"""WITH {_M}, x AS (SELECT CAST(seq % 4 AS INT) AS source, substr('GMXA', CAST(seq % 4 + 1 AS INT), 1) AS lv, CASE seq % 3 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'n' END AS name FROM m)
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE source = 3) AS BIGINT) AS wrong_source, CAST(count(*) FILTER (WHERE lv = 'X') AS BIGINT) AS wrong_level, CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) AS name_null, CAST(count(*) FILTER (WHERE trim(name) = '') AS BIGINT) AS name_blank, count(name) = 0 AS name_all_null FROM x""")
def validate_sources(spark, sf_dir):
    s = F.col("seq")
    x = matches(spark, sf_dir).select((s % 4).cast("int").alias("source"), F.substring(F.lit("GMXA"), (s % 4 + 1).cast("int"), F.lit(1)).alias("lv"), F.when(s % 3 == 0, None).when(s % 3 == 1, " ").otherwise("n").alias("name"))
    return tables.source_problems(x, ["name"], level="lv")


_DOB = """CASE o_orderkey % 8 WHEN 0 THEN '19' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || '0815' WHEN 1 THEN '19' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || '-03-07' WHEN 2 THEN '12/25/1980'
  WHEN 3 THEN '25/12/1980' WHEN 4 THEN 'unknown' WHEN 5 THEN '25-12-1981' WHEN 6 THEN '2015-01-01' ELSE NULL END"""
_HEIGHT = "CASE o_custkey % 5 WHEN 0 THEN '1.85m' WHEN 1 THEN '185 cm' WHEN 2 THEN '90' WHEN 3 THEN CAST(140 + o_orderkey % 90 AS VARCHAR) ELSE NULL END"


@query(f"""WITH x AS (SELECT o_orderkey AS k, {_DOB} AS d, {_HEIGHT} AS h, CASE o_custkey % 4 WHEN 0 THEN ' left ' WHEN 1 THEN 'R' WHEN 2 THEN 'Both' ELSE 'x' END AS w, o_custkey % 5 AS c, o_orderkey FROM orders),
y AS (SELECT *, CASE o_orderkey % 8 WHEN 0 THEN CAST(substr(d, 1, 4) || '-08-15' AS DATE) WHEN 1 THEN CAST(d AS DATE) WHEN 2 THEN DATE '1980-12-25' WHEN 3 THEN DATE '1980-12-25' WHEN 5 THEN DATE '1981-12-25' WHEN 6 THEN DATE '2015-01-01' END AS p FROM x)
SELECT k, CASE WHEN p BETWEEN DATE '1940-01-01' AND DATE '2008-01-01' THEN p END AS dob, CASE w WHEN ' left ' THEN 'L' WHEN 'R' THEN 'R' WHEN 'Both' THEN 'U' END AS hand, CAST(CASE WHEN c IN (0, 1) THEN 185 WHEN c = 3 AND 140 + o_orderkey % 90 BETWEEN 150 AND 220 THEN 140 + o_orderkey % 90 END AS INT) AS height FROM y""")
def scalar_metadata(spark, sf_dir):
    """Dates of birth, hands and heights as they are written, made valid or null."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    yy = F.lpad((c % 100).cast("string"), 2, "0")
    dob = F.when(k % 8 == 0, F.concat(F.lit("19"), yy, F.lit("0815"))).when(k % 8 == 1, F.concat(F.lit("19"), yy, F.lit("-03-07"))).when(k % 8 == 2, "12/25/1980").when(k % 8 == 3, "25/12/1980").when(k % 8 == 4, "unknown").when(k % 8 == 5, "25-12-1981").when(k % 8 == 6, "2015-01-01")
    height = F.when(c % 5 == 0, "1.85m").when(c % 5 == 1, "185 cm").when(c % 5 == 2, "90").when(c % 5 == 3, (k % 90 + 140).cast("string"))
    hand = F.when(c % 4 == 0, " left ").when(c % 4 == 1, "R").when(c % 4 == 2, "Both").otherwise("x")
    return _read(spark, sf_dir, "orders").select(k.alias("k"), S.valid_dob(dob, F.lit("2024-01-01").cast("date")).alias("dob"), S.valid_hand(hand).alias("hand"), S.valid_height(height).alias("height"))


@query(f"""WITH {_M} SELECT seq, round((tourney_date - DATE '1960-05-05') / 365.25, 1) AS age, CASE source WHEN 0 THEN 'main_dataset' WHEN 1 THEN 'infosys_api' WHEN 2 THEN 'tennis_api' ELSE 'unknown_3' END AS source, CAST(draw_size AS INT) AS draw, 'Mon 1' AS from_, CASE WHEN seq % 2 = 0 THEN 'Sun 7' END AS to_, 'ms' || seq AS match, CAST(greatest(a, b) AS DOUBLE) AS best
FROM (SELECT *, CAST(seq % 4 AS INT) AS source, CASE WHEN seq % 3 > 0 THEN 1.5 + seq % 10 END AS a, CASE WHEN seq % 5 > 0 THEN 2.0 + seq % 7 END AS b FROM m)""")
def scalar_calendar(spark, sf_dir):
    """Ages, sources, draws, dates and match ids as a calendar writes them, and the better of two prices."""
    s = F.col("seq")
    a, b = S.calendar_parts(F.when(s % 2 == 0, "Mon 1 - Sun 7").otherwise("Mon 1"))
    url = F.concat(F.lit("https://x.org/en/scores/2024/ms"), s.cast("string"), F.lit("/?q=1"))
    draw = S.draw_size(F.concat(F.lit("SGL "), F.col("draw_size").cast("string"), F.lit(" | DBL 16")))
    one, two = F.when(s % 3 > 0, 1.5 + s % 10), F.when(s % 5 > 0, 2.0 + s % 7)
    return matches(spark, sf_dir).select("seq", S.age(F.lit("1960-05-05").cast("date"), F.col("tourney_date")).alias("age"), S.source_name((s % 4).cast("int")).alias("source"), draw.alias("draw"), a.alias("from_"), b.alias("to_"), S.last_path_part(url).alias("match"), S.best_of(one, two).alias("best"))


@query(f"""WITH {_M} SELECT seq, CAST(p1_set1 AS INT) AS a1, CAST(p2_set1 AS INT) AS b1, CAST(p1_set2 AS INT) AS a2, CAST(p2_set2 AS INT) AS b2, 0 AS a3, 0 AS b3 FROM m""")
def unstacked_sets(spark, sf_dir):
    """The sets of a score as columns."""
    score = F.concat_ws(" ", *[F.concat(F.col(f"p1_set{i}").cast("string"), F.lit("-"), F.col(f"p2_set{i}").cast("string")) for i in (1, 2)])
    a, b = S.set_games(score, 1), S.set_games(score, 2)
    return matches(spark, sf_dir).select("seq", *[x.alias(f"{n}{i + 1}") for i in range(3) for n, x in (("a", a[i]), ("b", b[i]))])


@query(f"""WITH {_M} SELECT seq, CAST(CASE WHEN seq % 4 = 0 THEN p2_ace ELSE p1_ace END AS INT) AS p1_ace, CAST(CASE WHEN seq % 4 = 0 THEN p1_ace ELSE p2_ace END AS INT) AS p2_ace, CAST(CASE WHEN seq % 4 = 0 THEN p2_bpSaved ELSE p1_bpSaved END AS INT) AS p1_bpSaved, CAST(CASE WHEN seq % 4 = 0 THEN p2_bpFaced ELSE p1_bpFaced END AS INT) AS p1_bpFaced, 0 AS p1_df FROM m WHERE p1_ace IS NOT NULL""")
def json_match_stats(spark, sf_dir):
    """Statistics read from documents, each to the side whose id the document names."""
    s = F.col("seq")
    m = matches(spark, sf_dir).filter("p1_ace is not null")
    cell = lambda n, a, b: F.struct(F.lit(n).alias("name"), a.cast("string").alias("player1"), b.cast("string").alias("player2"))
    share = lambda p: F.format_string("%d/%d (9%%)", F.col(f"p{p}_bpSaved"), F.col(f"p{p}_bpFaced"))
    who = lambda p: F.struct(F.col(f"player{p}_id").cast("string").alias("player1Id"))
    # documents that name the players the other way round, with the statistics as they stand
    doc = F.to_json(F.struct(F.when(s % 4 == 0, F.array(who(2), who(1))).otherwise(F.array(who(1), who(2))).alias("players"), F.struct(F.array(cell("Aces", F.col("p1_ace"), F.col("p2_ace")), cell("Break Points Saved", share(1), share(2))).alias("set0")).alias("setStats")))
    out = match_stats(m.select("seq", "player1_id", "player2_id", doc.alias("doc")), "doc", {"Aces": "ace", "Double Faults": "df", "Break Points Saved": "bpSaved"}, {"Break Points Saved": "bpFaced"})
    return out.select("seq", "p1_ace", "p2_ace", "p1_bpSaved", "p1_bpFaced", "p1_df")


# ---- registers and metadata


def _sources(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Nations as entities, customers as their source rows."""
    e = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("entity_id"), F.col("n_name").alias("primary_name"))
    c = F.col("c_custkey")
    s = _read(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_nationkey").cast("long").alias("entity_id"), F.concat(F.lit("s"), (c % 3).cast("string")).alias("source"), c.cast("string").alias("source_id"), F.concat(F.lit("v"), (c % 7).cast("string")).alias("variant"))
    return e, s


@query("""WITH s AS (SELECT c_nationkey AS e, 's' || c_custkey % 3 AS source, 'v' || c_custkey % 7 AS v FROM customer WHERE c_nationkey < 20)
SELECT CAST(n_nationkey AS BIGINT) AS entity_id, n_name AS primary_name, CAST(count(DISTINCT source) AS BIGINT) AS sources, array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source IS NOT NULL)), ',') AS source_names, coalesce(array_to_string(list_sort(list(DISTINCT v) FILTER (WHERE v IS NOT NULL)), ','), '') AS variants FROM nation LEFT JOIN s ON e = n_nationkey GROUP BY 1, 2""")
def registry_info(spark, sf_dir):
    e, s = _sources(spark, sf_dir)
    return registry.info(e, s, "entity_id").withColumn("variants", F.array_join("variants", ",")).select("entity_id", "primary_name", F.col("sources").cast("long").alias("sources"), "source_names", "variants")


@query("""SELECT CAST(n_nationkey AS BIGINT) AS entity_id, n_name AS primary_name, CAST(c_custkey AS VARCHAR) AS source_id FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_nationkey < 20 AND c_custkey % 3 = 1""")
def registry_by_source(spark, sf_dir):
    e, s = _sources(spark, sf_dir)
    return registry.by_source(e, s, "entity_id", source="s1").select("entity_id", "primary_name", "source_id")


@query("""WITH r AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 4 = 0), x AS (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM r)) SELECT CAST(99999 + row_number() OVER (ORDER BY p_name) AS BIGINT) AS player_id, p_name FROM x""")
def registry_new_ids(spark, sf_dir):
    """Names that a register lacks, numbered in their order."""
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return tables.allocate_ids(part.filter("p_partkey % 4 = 0").select(F.lit(None).cast("long").alias("player_id"), "p_name"), part, "player_id", "p_name", 100000)


@query(f"WITH {_E}, n AS (SELECT player_id, count(*) AS n FROM e GROUP BY 1) SELECT CAST(count(*) AS BIGINT) AS players, CAST(floor(sum(n) / 2) AS BIGINT) AS matches, round(avg(n), 6) AS average, CAST(max(n) AS BIGINT) AS most, CAST(min(n) AS BIGINT) AS fewest FROM n")
def store_summary(spark, sf_dir):
    return _rounded(registry.events_summary(player_events(matches(spark, sf_dir))), ["average"])


_PLAYERS = "(SELECT c_custkey AS player_id, CASE WHEN c_custkey % 4 > 0 THEN CAST(140 + c_custkey % 100 AS VARCHAR) END AS h, CASE WHEN c_custkey % 3 > 0 THEN 'L' END AS w FROM customer)"


@query(f"""WITH {_M}, r AS {_PLAYERS}, v AS (SELECT player_id, CASE WHEN CAST(h AS INT) BETWEEN 150 AND 220 THEN CAST(h AS INT) END AS h, w FROM r),
x AS (SELECT seq, player1_id, CASE WHEN seq % 2 = 0 THEN 'unknown' ELSE '180' END AS ht, CASE seq % 3 WHEN 0 THEN 'R' WHEN 1 THEN '' END AS hand FROM m)
SELECT seq, CASE WHEN ht = 'unknown' AND v.h IS NOT NULL THEN CAST(v.h AS VARCHAR) ELSE ht END AS player1_ht, CASE WHEN (hand IS NULL OR hand = '') AND v.w IS NOT NULL THEN v.w ELSE hand END AS player1_hand,
  coalesce((ht = 'unknown' AND v.h IS NOT NULL) OR ((hand IS NULL OR hand = '') AND v.w IS NOT NULL), false) AS player1_metadata_updated FROM x LEFT JOIN v ON v.player_id = player1_id""")
def metadata_enriched(spark, sf_dir):
    """Empty cells of the first players filled from the register, where its value is valid."""
    s, c = F.col("seq"), F.col("c_custkey")
    m = matches(spark, sf_dir).select("seq", "player1_id", "player2_id", F.when(s % 2 == 0, "unknown").otherwise("180").alias("player1_ht"), F.when(s % 3 == 0, "R").when(s % 3 == 1, "").alias("player1_hand"))
    reg = _read(spark, sf_dir, "customer").select(c.alias("player_id"), F.when(c % 4 > 0, (140 + c % 100).cast("string")).alias("height"), F.lit(None).cast("string").alias("dob"), F.when(c % 3 > 0, "L").alias("hand"))
    valid = {"height": S.valid_height, "dob": S.valid_dob, "hand": S.valid_hand}
    return tables.enrich_metadata(m, reg, valid, S.is_empty).select("seq", "player1_ht", "player1_hand", "player1_metadata_updated")


@query(f"""WITH {_M}, x AS (SELECT player1_id AS player_id, CAST(130 + seq % 100 AS INT) AS h FROM m), b AS (SELECT player_id, min(h) AS h FROM x WHERE h BETWEEN 150 AND 220 GROUP BY 1)
SELECT CAST(c_custkey AS BIGINT) AS player_id, CASE WHEN c_custkey % 2 = 0 THEN '170' ELSE CAST(b.h AS VARCHAR) END AS height FROM customer LEFT JOIN b ON b.player_id = c_custkey""")
def metadata_synced(spark, sf_dir):
    """The register's empty heights filled from the matches."""
    c = F.col("c_custkey")
    m = matches(spark, sf_dir).select("player1_id", "player2_id", (130 + F.col("seq") % 100).cast("string").alias("player1_height"))
    reg = _read(spark, sf_dir, "customer").select(c.cast("long").alias("player_id"), F.when(c % 2 == 0, "170").alias("height"))
    return tables.sync_metadata(m, reg, {"height": S.valid_height}, S.is_empty)


# ---- prices


def _priced(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Matches with names and scores, and prices for most of them, some without ranks, under another event or written wrongly."""
    s = F.col("seq")
    won = F.col("RESULT") == 1
    m = matches(spark, sf_dir).withColumns({"player1_name": _name(F.col("player1_id")), "player2_name": _name(F.col("player2_id"))})
    games = lambda a, b: F.concat(*[x for i in (1, 2, 3) for x in (F.col(f"p{a}_set{i}").cast("string"), F.col(f"p{b}_set{i}").cast("string"))], F.lit("0000"))
    m = m.withColumn("score_key", F.when(won, games(1, 2)).otherwise(games(2, 1))).withColumn("match_id", s).withColumn("result", F.col("RESULT"))
    m = m.withColumn("event", F.concat_ws("-", F.col("tourney_id").cast("string"), F.date_format("tourney_date", "yyyyMM")))
    words = F.when(F.col("round") == "F", "The Final").when(F.col("round") == "SF", "Semifinals").when(F.col("round") == "QF", "Quarterfinals").otherwise(F.concat((F.log2(F.col("draw_size") / F.greatest(F.col("round_order"), F.lit(16))) + 1).cast("int").cast("string"), F.lit("th Round")))
    writes = lambda p: F.concat(F.split_part(F.col(f"player{p}_name"), F.lit(" "), F.lit(2)), F.lit(" "), F.substring(F.col(f"player{p}_name"), 1, 1), F.lit("."))
    side = lambda a, b: F.when(won, a).otherwise(b)
    o = m.filter(s % 10 != 9).select(
        s.alias("odds_id"), F.when(s % 10 != 8, F.col("event")).alias("tourney_id"), F.date_add("tourney_date", (s % 7).cast("int")).alias("date"), words.alias("round"),
        F.when(s % 10 < 5, side(F.col("player1_rank"), F.col("player2_rank"))).alias("wrank"), F.when(s % 10 < 5, side(F.col("player2_rank"), F.col("player1_rank"))).alias("lrank"),
        side(writes(1), writes(2)).alias("winner"), side(writes(2), writes(1)).alias("loser"), "score_key")
    return m.withColumn("tourney_id", F.col("event")), o


@query()
def odds_cascade(spark, sf_dir):
    """Every match through the five stages."""
    return odds.link(*_priced(spark, sf_dir))


@query()
def odds_methods(spark, sf_dir):
    return odds.method_counts(odds.link(*_priced(spark, sf_dir)))


@query()
def odds_events(spark, sf_dir):
    """Bookmakers' tournaments against the registered ones."""
    n = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("entity_id"), F.initcap("n_name").alias("variant"), F.when(F.col("n_nationkey") % 2 == 0, "A").otherwise("G").alias("level"))
    k = F.col("n_nationkey")
    p = _read(spark, sf_dir, "nation").select(F.when(k % 3 == 0, F.initcap("n_name")).otherwise(F.concat(F.initcap("n_name"), F.lit(" Open"))).alias("tournament"), F.when(k % 4 == 0, F.initcap("n_name")).alias("location"), F.lit("ATP250").alias("series"))
    return odds.match_events(p, n, S.tokens).drop("found")


@query()
def join_ratio_top(spark, sf_dir):
    """Part names with a slip against all names: the best of 85 per cent or more."""
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    slips = part.select(F.concat(F.col("p_name"), F.lit("s")).alias("name")).distinct()
    return linkage.best_by_similarity(slips, part.groupBy(F.col("p_name").alias("variant")).agg(F.min("p_partkey").alias("k")), "name", "variant", ratio_percent(F.lower("name"), F.lower("variant")), S.tokens, keep=1, least=85.0)


@query()
def resolve_tournaments(spark, sf_dir):
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name", "p_type")
    reg = part.filter("p_type = 'ECONOMY'").groupBy("p_name").agg(F.min("k").alias("k")).select(F.col("k").cast("long").alias("entity_id"), F.lit("a").alias("source"), F.col("k").cast("string").alias("source_id"), F.col("p_name").alias("variant"))
    men = part.select(F.when(F.col("k") % 5 == 0, "a").otherwise("b").alias("source"), F.col("k").cast("string").alias("source_id"), F.when(F.col("k") % 7 == 0, F.concat("p_name", F.lit("s"))).otherwise(F.col("p_name")).alias("name"))
    return resolve.match_tournaments(men, reg, S.tokens)


@query()
def resolve_players(spark, sf_dir):
    m = matches(spark, sf_dir)
    p = m.select(F.explode(F.array("player1_id", "player2_id")).alias("i")).distinct()
    reg = p.filter("i % 3 = 0").select((F.col("i") + 100000).cast("long").alias("entity_id"), F.lit("a").alias("source"), F.col("i").cast("string").alias("source_id"), _name(F.col("i")).alias("variant"))
    men = p.select(F.when(F.col("i") % 2 == 0, "a").otherwise("b").alias("source"), F.col("i").cast("string").alias("source_id"), F.when(F.col("i") % 5 == 0, F.concat(_name(F.col("i")), F.lit("e"))).otherwise(_name(F.col("i"))).alias("name"))
    return resolve.match_players(men, reg, lambda c: F.split(player_key(c), "-"), automatic=True)


@query()
def elo_archived(spark, sf_dir):
    """Ratings in the archived order of rounds."""
    return _rounded(rating.rate(rating.archived_order(matches(spark, sf_dir))), ["pre", "post"])


@query(f"""WITH {_M} SELECT seq, row_number() OVER (ORDER BY tourney_date, tourney_id, round_order DESC, seq) AS place FROM m""")
def chronological_place(spark, sf_dir):
    """The place of each match in the order of time, counted by day first."""
    m = matches(spark, sf_dir)
    days = m.groupBy("tourney_date").agg(F.count("*").alias("k"))
    before = days.select("tourney_date", F.coalesce(F.sum("k").over(Window.orderBy("tourney_date").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    w = Window.partitionBy("tourney_date").orderBy(F.asc_nulls_last("tourney_id"), F.desc_nulls_last("round_order"), "seq")
    return m.withColumn("n", F.row_number().over(w)).join(before, "tourney_date").select("seq", (F.col("n") + F.col("b")).cast("long").alias("place"))


@query(f"""WITH {_M}, q AS (SELECT *, row_number() OVER (PARTITION BY tourney_id, tourney_date, round ORDER BY seq) AS n FROM m) SELECT tourney_id, tourney_date, round, seq FROM q WHERE n = 1""")
def first_rows(spark, sf_dir):
    return tables.first_of(matches(spark, sf_dir), ["tourney_id", "tourney_date", "round"], ["seq"]).select("tourney_id", "tourney_date", "round", "seq")


@query(f"""WITH {_M}, b0 AS (SELECT seq, RESULT, 0.2 + (seq % 61) / 100.0 AS p1, 1.2 + (player1_id % 30) / 10.0 AS odds1, 1.2 + (player2_id % 30) / 10.0 AS odds2 FROM m),
b AS (SELECT seq, CASE WHEN odds1 * p1 - 1 >= odds2 * (1 - p1) - 1 THEN odds1 ELSE odds2 END AS odds, CASE WHEN odds1 * p1 - 1 >= odds2 * (1 - p1) - 1 THEN RESULT ELSE 1 - RESULT END AS won, greatest(odds1 * p1 - 1, odds2 * (1 - p1) - 1) AS ev FROM b0)
SELECT seq, round(sum(CASE WHEN won = 1 THEN 10 * (odds - 1) ELSE -10 END) OVER (ORDER BY seq), 4) AS cum_profit FROM b WHERE ev >= 0.2 + 1e-9""")
def cumulative_profit(spark, sf_dir):
    b = _bets(spark, sf_dir).filter(F.col("ev") >= 0.2 + 1e-9).withColumns({"strategy": F.lit("flat"), "profit": F.when(F.col("won") == 1, 10 * (F.col("odds") - 1)).otherwise(-10.0)})
    return backtest.cumulative_profit(b).select("seq", F.round("cum_profit", 4).alias("cum_profit"))


# ---- scalars as texts


@query("""SELECT o_orderkey AS k, CAST(CASE o_orderkey % 6 WHEN 5 THEN NULL ELSE CAST(o_orderdate AS DATE) + 10957 END AS DATE) AS parsed FROM orders""")
def scalar_dates(spark, sf_dir):
    """Dates in the forms that sources write, spreadsheet numbers among them."""
    k, d = F.col("o_orderkey"), F.date_add(F.col("o_orderdate").cast("date"), 10957)
    serial = F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")
    rep = F.format_string("datetime.datetime(%d, %d, %d, 0, 0)", F.year(d), F.month(d), F.dayofmonth(d))
    text = F.when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 6 == 1, F.date_format(d, "yyyyMMdd")).when(k % 6 == 2, rep).when(k % 6 == 3, serial).when(k % 6 == 4, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 10:30:00"))).otherwise("soon")
    return _read(spark, sf_dir, "orders").select(k.alias("k"), S.parse_date(text).alias("parsed"))


_ENDED = "CASE o_orderkey % 4 WHEN 0 THEN ' RET' WHEN 1 THEN ' W/O' ELSE '' END"


@query(f"""WITH x AS (SELECT o_orderkey AS k, CAST(o_orderkey % 8 AS INT) AS a, CAST(o_custkey % 8 AS INT) AS b, o_orderkey % 4 < 2 AS early FROM orders)
SELECT k, '6-4 7-6(' || a || ') ' || a || '-' || b || CASE k % 4 WHEN 0 THEN ' RET' WHEN 1 THEN ' W/O' ELSE '' END AS expanded, CAST(CASE WHEN early AND a < 6 AND b < 6 THEN 2 ELSE 3 END AS INT) AS sets, 1 AS tiebreaks, early AS ended_early, CAST(CASE WHEN early AND a < 6 AND b < 6 THEN 3 ELSE 3 + a - b END AS INT) AS margin FROM x""")
def scalar_scores(spark, sf_dir):
    """Compact scores written out, and what is left of a match that ended early."""
    k, a, b = F.col("o_orderkey"), (F.col("o_orderkey") % 8).cast("string"), (F.col("o_custkey") % 8).cast("string")
    compact = F.concat(F.lit("64 76("), a, F.lit(") "), a, b, F.when(k % 4 == 0, " RET").when(k % 4 == 1, " W/O").otherwise(""))
    full = S.full_score(S.expand_score(compact))
    return _read(spark, sf_dir, "orders").select(k.alias("k"), S.expand_score(compact).alias("expanded"), full["sets"].alias("sets"), full["tiebreaks"].alias("tiebreaks"), full["ended_early"].alias("ended_early"), full["margin"].alias("margin"))


@query(f"""WITH {_M}, x AS (SELECT seq, draw_size, CAST(seq % 7 + 1 AS INT) AS n FROM m), y AS (SELECT *, floor(draw_size / pow(2, n - 1)) AS l FROM x)
SELECT seq, CASE WHEN n = 6 THEN 'F' WHEN n = 7 THEN NULL WHEN l > 64 THEN 'R128' WHEN l > 32 THEN 'R64' WHEN l > 16 THEN 'R32' WHEN l > 8 THEN 'R16' WHEN l > 4 THEN 'QF' WHEN l > 2 THEN 'SF' ELSE 'F' END AS round, round(3 + 2 * log2(draw_size), 6) AS days, CASE WHEN n = 3 THEN 907 WHEN n = 4 THEN 999 ELSE 3 END AS place FROM y""")
def scalar_rounds(spark, sf_dir):
    """Bookmakers' rounds by draw, days in which an event can be priced, and places of group and unknown rounds."""
    n = (F.col("seq") % 7 + 1).cast("int")
    words = F.when(n == 6, "The Final").when(n == 7, "odd").otherwise(F.concat(n.cast("string"), F.lit("th Round")))
    code = F.when(n == 3, "907").when(n == 4, "XX").otherwise("BR")
    return matches(spark, sf_dir).select("seq", S.odds_round(words, F.col("draw_size")).alias("round"), F.round(S.date_buffer_days(F.col("draw_size")), 6).alias("days"), S.round_order(code).cast("int").alias("place"))


@query("""SELECT p_partkey AS k, '0339' AS tourney, '25' AS year, '002' AS round, 'AB' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || '_UNK00' AS players, 'ATP ' || upper(substr(p_brand, 1, 1)) || lower(substr(p_brand, 2)) || ' US' AS title, p_partkey % 3 = 0 AS empty FROM part""")
def scalar_ids(spark, sf_dir):
    """Match ids taken apart, titles, and what counts as empty."""
    k = F.col("p_partkey")
    mid = S.match_id(F.lit(339), F.lit("2024-12-25").cast("date"), F.lit("F"), F.lit("ann brook"), k, F.lit(""), F.lit(None).cast("int"))
    parts = S.match_id_parts(mid)
    word = F.when(k % 6 == 0, " N/A ").when(k % 3 == 0, "0").otherwise("x")
    return _read(spark, sf_dir, "part").select(k.alias("k"), *[parts[c].alias(c) for c in ("tourney", "year", "round", "players")], S.title(F.concat(F.lit("atp  "), F.col("p_brand"), F.lit(" us "))).alias("title"), S.is_empty(word).alias("empty"))


@query(f"""WITH {_M} SELECT seq AS player1_ace, CAST(p1_ace AS BIGINT) AS p1_ace, CAST(p2_ace AS BIGINT) AS p2_ace, player2_id AS player2_id FROM m""")
def renamed_sides(spark, sf_dir):
    """Winner and loser columns under the players' names."""
    m = matches(spark, sf_dir).select(F.col("seq").alias("winner_ace"), F.col("p1_ace").alias("w_ace"), F.col("p2_ace").alias("l_ace"), F.col("player2_id").alias("loser_id"))
    return tables.rename_sides(m)


@query(f"""WITH {_M} SELECT seq, tourney_date FROM m WHERE seq % 2 = 0 UNION ALL SELECT seq, tourney_date FROM m WHERE seq % 2 = 1""")
def merged_matches(spark, sf_dir):
    """New matches merged into the stored ones; none twice."""
    m = matches(spark, sf_dir).select("seq", "tourney_date")
    return tables.upsert(m.filter("seq % 2 = 0"), m.union(m), "seq", replace=False)
