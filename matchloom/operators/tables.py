"""Table operators: validation, filters, projection to a schema, dedupe, upsert, incremental merge, registries, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require(df: DataFrame, columns: dict[str, str | None]) -> dict:
    """Checks an input: every column there, rows there, and each typed column castable. Returns counts; raises on the first two.

    columns: names, and the type that a cell must allow, or None.
    """
    missing = missing_columns(df, list(columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    typed = {c: t for c, t in columns.items() if t is not None}
    bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in typed.items()]
    found = df.agg(F.count("*").alias("__rows"), *bad).first().asDict()
    if not found["__rows"]:
        raise ValueError("no rows")
    return {"rows": found.pop("__rows"), "uncastable": {c: n for c, n in found.items() if n}}


def bad_keys(df: DataFrame, key: Column, limit: int = 10) -> DataFrame:
    """The first rows, in the order of all their cells, whose key can't be read; limit is the report's."""
    return df.filter(key.isNull()).orderBy(*df.columns).limit(limit)


def valid_matches(df: DataFrame, ids: list[str], keys: list[str]) -> DataFrame:
    """Ids as integers where they allow; rows that lack an id or a part of the key go."""
    return df.withColumns({c: F.col(c).try_cast("double").try_cast("long") for c in ids}).na.drop(subset=[*ids, *keys])


#: Codes of sources, levels of tournaments.
SOURCE_CODES, LEVELS = (0, 1, 2), ("G", "M", "F", "D", "A", "C", "S", "O")


def source_problems(df: DataFrame, columns: list[str], source: str = "source", level: str | None = None) -> DataFrame:
    """One row: rows, wrong sources and levels, and for each column its null, its blank and whether all its cells are null."""
    out = [F.count("*").alias("n_rows"), F.count_if(~F.coalesce(F.col(source).isin(*SOURCE_CODES), F.lit(False))).alias("wrong_source")]
    out += [F.count_if(~F.coalesce(F.col(level).isin(*LEVELS), F.lit(False))).alias("wrong_level")] if level else []
    for c in columns:
        out += [F.count_if(F.col(c).isNull()).alias(f"{c}_null"), F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"{c}_blank"), (F.count(c) == 0).alias(f"{c}_all_null")]
    return df.agg(*out)


def drop_missing(df: DataFrame, subset: list[str], how: str = "any") -> DataFrame:
    """Rows with any, or with all, of these cells null or NaN go."""
    return df.na.drop(how=how, subset=subset)


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c, t in df.dtypes if t == "string"})


def singles_only(df: DataFrame, names: list[str], round_: str = "round", tournament: str = "tourney_name", leave: tuple[str, ...] = ("United Cup",)) -> DataFrame:
    """Rows of doubles (a comma in a name), early rounds (ER) and some tournaments go; what is null stays."""
    keep = F.coalesce(F.col(round_) != "ER", F.lit(True)) & F.coalesce(~F.col(tournament).isin(*leave), F.lit(True))
    for c in names:
        keep = keep & ~F.coalesce(F.col(c).contains(","), F.lit(False))
    return df.filter(keep)


def drop_first(df: DataFrame, condition: Column, order: list) -> DataFrame:
    """Without the first row, in an order, that meets a condition; found by an aggregate, so no window over all rows."""
    first = df.filter(condition).agg(F.min(F.struct(*order)).alias("f"))
    mine = F.struct(*order)
    return df.join(F.broadcast(first.filter("f is not null")), condition & mine.eqNullSafe(F.col("f")), "left_anti")  # one row


def derived_stats(df: DataFrame) -> DataFrame:
    """p1_ and p2_: bpconv (break points won), bp_rg (faced by the opponent per service game, null where there is none), tpw
    (points won serving and returning), sw (games won in all sets)."""
    new = {}
    for p, o in ((1, 2), (2, 1)):
        c = lambda n, s=p: F.col(f"p{s}_{n}")
        new[f"p{p}_bpconv"] = c("bpFaced", o) - c("bpSaved", o)
        new[f"p{p}_bp_rg"] = F.try_divide(c("bpFaced", o), c("SvGms", o))
        new[f"p{p}_tpw"] = c("1stWon") + c("2ndWon") + c("svpt", o) - c("1stWon", o) - c("2ndWon", o)
        new[f"p{p}_sw"] = sum((F.coalesce(F.col(f"p{p}_set{i}"), F.lit(0)) for i in range(1, 6) if f"p{p}_set{i}" in df.columns), F.lit(0))
    return df.withColumns(new)


def irregular_names(df: DataFrame, name: str) -> DataFrame:
    """Rows whose name is null, holds other than letters, spaces, hyphens, apostrophes and dots, or occurs more than once; and why."""
    often = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("__n")).filter("__n > 1")
    j = df.join(often, name, "left")
    why = F.when(F.col(name).isNull(), "null").when(~F.col(name).rlike(r"^[\p{L} \-'.]+$"), "irregular").when(F.col("__n").isNotNull(), "repeated")
    return j.withColumn("problem", why).filter("problem is not null").select(*df.columns, "problem")


#: Names under which metadata columns occur, in any case, after player1_ or p1_ (or 2).
ALIASES = {"height": ("height", "ht"), "dob": ("dob", "birthdate", "birth_date", "date_of_birth"), "hand": ("hand", "handedness", "plays")}


def metadata_columns(columns: list[str]) -> dict[int, dict[str, str]]:
    """For players 1 and 2, which column holds which metadata; the first alias that is there counts."""
    low = {c.lower(): c for c in reversed(columns)}
    return {p: {what: low[f"{lead}{p}_{a}"] for what, names in ALIASES.items() for lead, a in [next(((x, y) for y in names for x in ("player", "p") if f"{x}{p}_{y}" in low), ("", ""))] if a} for p in (1, 2)}


def enrich_metadata(df: DataFrame, players: DataFrame, valid: dict, empty) -> DataFrame:
    """Empty metadata cells of both players take the registry's, if it is valid there; player1_metadata_updated and
    player1_metadata_source (and 2) tell. players: player_id, height, dob, hand; valid: a function of a cell per field."""
    out = df
    for p, held in metadata_columns(df.columns).items():
        reg = players.select(F.col("player_id").alias("__id"), *[valid[w](F.col(w).cast("string")).cast("string").alias(f"__{w}") for w in held])
        out = out.join(reg, F.col(f"player{p}_id") == F.col("__id"), "left")
        fill = {w: empty(F.col(c).cast("string")) & F.col(f"__{w}").isNotNull() for w, c in held.items()}
        any_ = F.lit(False)
        for f in fill.values():
            any_ = any_ | f
        out = out.withColumn(f"player{p}_metadata_updated", any_).withColumn(f"player{p}_metadata_source", F.when(any_, "database"))
        out = out.withColumns({c: F.when(fill[w], F.col(f"__{w}").try_cast(df.schema[c].dataType)).otherwise(F.col(c)) for w, c in held.items()}).drop("__id", *[f"__{w}" for w in held])
    return out


def sync_metadata(df: DataFrame, players: DataFrame, valid: dict, empty) -> DataFrame:
    """players whose empty fields take what the matches say: of a player's valid values the least."""
    sides = metadata_columns(df.columns)
    fields = sorted(set(sides[1]) | set(sides[2]))
    said = None
    for p, held in sides.items():
        cell = lambda w, h=held: F.when(~empty(F.col(h[w]).cast("string")), valid[w](F.col(h[w]).cast("string")).cast("string")) if w in h else F.lit(None).cast("string")
        one = df.select(F.col(f"player{p}_id").alias("player_id"), *[cell(w).alias(f"__{w}") for w in fields])
        said = one if said is None else said.unionByName(one)
    best = said.filter("player_id is not null").groupBy("player_id").agg(*[F.min(f"__{w}").alias(f"__{w}") for w in fields])
    j = players.join(best, "player_id", "left")
    return j.withColumns({w: F.when(empty(F.col(w).cast("string")), F.col(f"__{w}").try_cast(players.schema[w].dataType)).otherwise(F.col(w)) for w in fields}).select(*players.columns)


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: how many rows break each rule, in one pass."""
    return df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()], F.count("*").alias("n_rows"))


def apply_filters(df: DataFrame, *, start=None, end=None, date: str = "tourney_date", **members) -> DataFrame:
    """Inclusive dates and IN lists; a filter on an absent column is skipped. Plain predicates, so they reach the scan."""
    if start is not None and date in df.columns:
        df = df.filter(F.col(date) >= F.lit(start))
    if end is not None and date in df.columns:
        df = df.filter(F.col(date) <= F.lit(end))
    for c, values in members.items():
        if values is not None and c in df.columns:
            df = df.filter(F.col(c).isin(list(values)))
    return df


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns in this order; absent ones null, others cast where the value allows."""
    return df.select(*[(F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])


def rename_sides(df: DataFrame) -> DataFrame:
    """winner/loser and w_/l_ columns become player1/2 and p1_/p2_."""
    new = lambda c: c.replace("winner_", "player1_").replace("loser_", "player2_") if c.startswith(("winner_", "loser_")) else {"w_": "p1_", "l_": "p2_"}.get(c[:2], c[:2]) + c[2:]
    return df.withColumnsRenamed({c: new(c) for c in df.columns if new(c) != c})


def swap_sides(df: DataFrame, pairs: list[tuple[str, str]], result: str, by: Column) -> DataFrame:
    """Half of the rows, by a hash and so always the same, with the two sides and the result exchanged."""
    swap = F.pmod(F.xxhash64(by), F.lit(2)) == 1
    out = {a: F.when(swap, F.col(b)).otherwise(F.col(a)) for a, b in pairs} | {b: F.when(swap, F.col(a)).otherwise(F.col(b)) for a, b in pairs}
    return df.withColumns(out | {result: F.when(swap, 1 - F.col(result)).otherwise(F.col(result))})


def first_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row of each key."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")


def split_new(existing: DataFrame, incoming: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(duplicates, new) of incoming."""
    return incoming.join(existing.select(key), key, "left_semi"), incoming.join(existing.select(key), key, "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, key: str, replace: bool = True) -> DataFrame:
    """replace: incoming rows win; else existing ones stay and only new keys enter. Of a key that comes in more than once the
    least row counts."""
    rest = [c for c in incoming.columns if c != key]
    incoming = incoming.groupBy(key).agg(F.min(F.struct(*rest)).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*incoming.columns) if rest else incoming.distinct()
    if replace:
        return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True)
    return existing.unionByName(incoming.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def chronological(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("tourney_date"), F.asc_nulls_last("tourney_id"), F.desc_nulls_last("round_order"), "seq")


def numbered(df: DataFrame, name: str, prefix: int = 3) -> DataFrame:
    """df and n = 0, 1, 2... in the order of a text column of distinct values: places among those of the same first
    characters, and before them all that begin with lesser ones. Only the sizes by first characters meet in one task."""
    part = df.withColumn("__p", F.substring(name, 1, prefix))
    sizes = part.groupBy("__p").agg(F.count("*").alias("__k"))
    before = sizes.select("__p", F.coalesce(F.sum("__k").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    placed = part.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(name)) - 1)
    return placed.join(before, "__p").withColumn("n", F.col("__n") + F.col("__before")).drop("__p", "__n", "__before")


def allocate_ids(registry: DataFrame, names: DataFrame, id_col: str, name: str, base: int) -> DataFrame:
    """Names that the registry lacks, numbered on from its greatest id in the order of the names."""
    new = names.select(name).distinct().join(registry.select(name), name, "left_anti")
    top = registry.agg(F.coalesce(F.max(id_col), F.lit(base - 1))).first()[0]
    return numbered(new, name).select((F.lit(top + 1) + F.col("n")).cast("long").alias(id_col), name)


def fill_empty(df: DataFrame, other: DataFrame, key: str, columns: list[str], empty) -> DataFrame:
    """Cells that count as empty take the other table's; filled says whether any did."""
    o = other.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    j = df.join(o, key, "left")
    filled = F.lit(False)
    for c in columns:
        filled = filled | (empty(F.col(c)) & F.col(f"__{c}").isNotNull())
    return j.withColumn("filled", filled).withColumns({c: F.when(empty(F.col(c)), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).drop(*[f"__{c}" for c in columns])


def round_robin_codes(df: DataFrame) -> DataFrame:
    """RR rows get '9' and their place, of two digits at least, by match number within tournament and date; descending if the final's number is over 5."""
    w = Window.partitionBy("tourney_id", "tourney_date")
    final = F.max(F.when(F.col("round") == "F", F.col("match_num"))).over(w)
    up = F.coalesce(final <= 5, F.lit(True))
    place = F.row_number().over(Window.partitionBy("tourney_id", "tourney_date", F.col("round") == "RR").orderBy(F.when(up, F.col("match_num")).otherwise(-F.col("match_num")), "seq")) - 1
    return df.withColumn("round", F.when(F.col("round") == "RR", F.format_string("9%02d", place)).otherwise(F.col("round")))
