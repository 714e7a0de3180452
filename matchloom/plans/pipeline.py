"""Stages that compose the operators: prepare, identify, key, deduplicate, merge, price; and events and ratings from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import odds as prices
from ..operators import rating, resolve, tables
from ..operators.events import player_events
from ..sources.store import Store, log_run

#: What a raw match must have, and as which type a cell must be readable.
REQUIRED = {"tourney_id": None, "tourney_name": None, "tourney_date": "date", "tourney_level": None, "surface": None, "round": None, "match_num": "int", "best_of": "int", "player1_id": None, "player1_name": None, "player2_id": None, "player2_name": None, "score": None, "source": "int"}


@dataclass
class Report:
    """What became of a run's rows."""

    facts: dict = field(default_factory=dict)


def prepare(raw: DataFrame, *, swap: bool = True) -> DataFrame:
    """Sets from scores, derived statistics, types, and (swap) half of the rows with their sides exchanged, by a hash.

    The winner stands first in raw rows; RESULT is 1 where it still does.
    """
    m = raw
    for p in (1, 2):
        for i, games in enumerate(S.set_games(F.col("score"), p), 1):
            m = m.withColumn(f"p{p}_set{i}", games)
    stats = [c for c in ("svpt", "1stWon", "2ndWon", "SvGms", "bpFaced", "bpSaved") if f"p1_{c}" not in m.columns]
    m = m.withColumns({f"p{p}_{c}": F.lit(None).cast("double") for p in (1, 2) for c in stats})
    m = tables.derived_stats(m)
    m = m.withColumns({"RESULT": F.lit(1), "tourney_date": S.parse_date(F.col("tourney_date").cast("string")), "match_num": F.col("match_num").try_cast("int"), "best_of": F.col("best_of").try_cast("int")})
    if not swap:
        return m
    pairs = [(a, b) for a in m.columns for b in [a.replace("player1_", "player2_") if a.startswith("player1_") else "p2_" + a[3:] if a.startswith("p1_") else None] if b in m.columns]
    return tables.swap_sides(m, pairs, "RESULT", F.concat_ws("|", "tourney_id", "tourney_date", "match_num", *[F.array_sort(F.array("player1_id", "player2_id"))[i] for i in (0, 1)]))


def identify(m: DataFrame, *, tournaments: DataFrame | None = None, players: DataFrame | None = None, decisions: DataFrame | None = None, automatic: bool = True) -> tuple[DataFrame, DataFrame]:
    """(matches with resolved identifiers, what is left to people). Registries: entity_id, source, source_id, variant."""
    review = None
    text = m.withColumns({"source": F.col("source").cast("string"), **{c: F.col(c).cast("string") for c in ("tourney_id", "player1_id", "player2_id")}})
    if tournaments is not None:
        mentions = text.select("source", F.col("tourney_id").alias("source_id"), F.col("tourney_name").alias("name"))
        out = resolve.match_tournaments(mentions, tournaments, S.tokens, decisions=decisions)
        text = resolve.applied(text, out, source="source", source_id="tourney_id", name="tourney_name", into="tourney_id")
        review = out.filter("action in ('review', 'confirm', 'review_known_id')")
    if players is not None:
        mentions = text.select("source", F.inline(F.array(*[F.struct(F.col(f"player{p}_id").alias("source_id"), F.col(f"player{p}_name").alias("name")) for p in (1, 2)])))
        out = resolve.match_players(mentions, players, lambda c: F.split(resolve.player_key(c), "-"), automatic=automatic)
        for p in (1, 2):
            text = resolve.applied(text, out, source="source", source_id=f"player{p}_id", name=f"player{p}_name", into=f"player{p}_id")
        left = out.filter("action in ('manual_needed', 'error')")
        review = left if review is None else review.unionByName(left)
    ids = {c: F.col(c).try_cast("long") for c in ("tourney_id", "player1_id", "player2_id")}
    return text.withColumns(ids), review


def key(m: DataFrame) -> DataFrame:
    """Round robin codes, round_order, match_id and seq; rows without an id or a part of the key go."""
    m = tables.round_robin_codes(m.withColumn("seq", F.xxhash64("tourney_id", "tourney_date", "match_num", "player1_id", "player2_id")))
    m = tables.valid_matches(m, ["tourney_id", "player1_id", "player2_id"], ["tourney_date", "round"])
    m = m.withColumn("round_order", S.round_order(F.col("round")))
    mid = S.match_id(F.col("tourney_id"), F.col("tourney_date"), F.col("round"), F.col("player1_name"), F.col("player1_id"), F.col("player2_name"), F.col("player2_id"))
    return m.withColumn("match_id", mid)


def _stored(store: Store, name: str, df: DataFrame) -> DataFrame:
    store.write(name, df)
    return store.read(name)


def link(m: DataFrame, odds: DataFrame) -> DataFrame:
    """The price cascade's outcome for keyed matches. odds: as odds.link() takes them, and price columns."""
    games = lambda a, b: F.concat(*[x for i in range(1, 6) for x in (F.col(f"p{a}_set{i}").cast("string"), F.col(f"p{b}_set{i}").cast("string"))])
    rows = m.withColumn("score_key", F.when(F.col("RESULT") == 1, games(1, 2)).otherwise(games(2, 1))).withColumn("result", F.col("RESULT"))
    for c in ("player1_rank", "player2_rank", "draw_size"):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("int"))
    need = ["match_id", "tourney_id", "tourney_date", "draw_size", "round", "player1_rank", "player2_rank", "player1_name", "player2_name", "result", "score_key"]
    return prices.link(rows.select(*need), odds)


def priced(m: DataFrame, odds: DataFrame, outcome: DataFrame) -> DataFrame:
    """Matches with prices, where one was found."""
    d = lambda c: F.col(c).cast("double") if c in odds.columns else F.lit(None).cast("double")
    found = outcome.filter("status = 'enriched'").join(odds, "odds_id")
    cols = S.oriented_prices(F.col("orientation") == 1, (d("maxw"), d("maxl")), (d("psw"), d("psl")), (d("b365w"), d("b365l")))
    found = found.select("match_id", *[c.alias(k) for k, c in cols.items()], F.col("confidence").alias("enrichment_confidence"), F.col("method").alias("enrichment_method"))
    return m.join(found, "match_id", "left")


def run(raw: DataFrame, store: Store, *, odds: DataFrame | None = None, tournaments: DataFrame | None = None, players: DataFrame | None = None, replace: bool = False, log: str | None = None) -> Report:
    """Raw matches into the store: matches, review, events and ratings. Running it again with the same rows changes nothing.

    Events enter for new matches only; ratings go on from the stored ones, or are replayed from the first new match if
    that comes before a rated one.
    """
    facts: dict = {"input": tables.require(raw, REQUIRED)["rows"]}
    # each stage is written once: the next ones read it more than once
    m, review = identify(prepare(raw), tournaments=tournaments, players=players)
    m = _stored(store, "keyed", key(m))
    if odds is not None:
        outcome = _stored(store, "prices", link(m, odds))
        facts["priced"] = outcome.filter("status = 'enriched'").count()
        m = _stored(store, "priced", priced(m, odds, outcome))
    before = store.read("matches")
    fresh = m.dropDuplicates(["match_id"]) if before is None else tables.split_new(before, m.dropDuplicates(["match_id"]), "match_id")[1]
    store.write("fresh", fresh)  # written before anything that it is compared with changes
    fresh = store.read("fresh")
    facts["new"] = fresh.count()
    store.append_new("matches", m, "match_id", replace)
    if review is not None:
        store.write("review", review)
        facts["review"] = store.read("review").count()
    if facts["new"]:
        store.append_events("events", player_events(fresh))
        rated = store.read("ratings")
        if rated is None:
            store.write("ratings", rating.rate(fresh))
        elif rating.needs_replay(fresh, rated):
            store.write("ratings", rating.replay(before, fresh.select(*before.columns), rated))
        else:
            store.write("ratings", rated.unionByName(rating.rate(fresh, rated)))
    if log:
        log_run(raw.sparkSession, log, **facts)
    return Report(facts)
