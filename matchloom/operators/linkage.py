"""Joins of record linkage: nearest in time, by interval, in either orientation, and cascades of ever looser keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(left: DataFrame, right: DataFrame, by: list[str], left_date: str, right_date: str, days: int, left_id: str) -> DataFrame:
    """left with the right row of the same keys whose date is nearest within days; of equally near ones the earlier.

    Equal keys and a day bucket: each left row meets the three buckets around it, so a frequent key never meets itself
    whole. The choice is an aggregate with map-side combining, not a sort.
    """
    width = days + 1
    bucket = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width)
    r = right.select(*by, F.struct(*[c for c in right.columns if c not in by]).alias("__r"), bucket(right_date).alias("__b"))
    tries = left.select(*by, left_id, left_date, F.explode(F.array(*[bucket(left_date) + i for i in (-1, 0, 1)])).alias("__b"))
    gap = F.datediff(F.col(f"__r.{right_date}"), F.col(left_date))
    found = tries.join(r, [*by, "__b"]).filter(F.abs(gap) <= days)
    best = found.groupBy(left_id).agg(F.min(F.struct(F.abs(gap).alias("gap"), F.col(f"__r.{right_date}").alias("on"), F.col("__r").alias("row"))).alias("__best"))
    return left.join(best, left_id, "left").select(*left.columns, F.col("__best.gap").alias("gap"), *[F.col(f"__best.row.{c}").alias(c if c not in left.columns else f"{c}_r") for c in right.columns if c not in by])


def within(left: DataFrame, right: DataFrame, left_from: Column, left_to: Column, right_date: str, bucket_days: int = 7) -> DataFrame:
    """Pairs whose right date lies in the left interval; both sides share week buckets, so the join is by equal keys."""
    day = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bucket_days)
    a = left.withColumns({"__from": left_from, "__to": left_to}).filter("__from <= __to").withColumn("__b", F.explode(F.sequence(day(F.col("__from")), day(F.col("__to")))))
    b = right.withColumn("__b", day(F.col(right_date)))
    return a.join(b, "__b").filter(F.col(right_date).between(F.col("__from"), F.col("__to"))).drop("__b", "__from", "__to")


def either_side(matches: DataFrame, odds: DataFrame, first: tuple[str, str], second: tuple[str, str], match_id: str, also: Column | None = None) -> DataFrame:
    """Two joins by equal keys instead of one by OR: (winner, loser) as (1, 2) goes before the swapped order. also: more to hold."""
    a, b = first
    w, l = second
    also = F.lit(True) if also is None else also
    straight = matches.join(odds, (F.col(a) == F.col(w)) & (F.col(b) == F.col(l)) & also).withColumn("orientation", F.lit(1))
    swapped = matches.join(odds, (F.col(a) == F.col(l)) & (F.col(b) == F.col(w)) & also).withColumn("orientation", F.lit(2))
    both = straight.unionByName(swapped)
    return both.withColumn("__least", F.min("orientation").over(Window.partitionBy(match_id))).filter("orientation = __least").drop("__least")


def cascade(left: DataFrame, right: DataFrame, steps: list[tuple[str, list[str]]], left_id: str, right_id: str) -> DataFrame:
    """left with right_id and method: of each step's keys, only those that are unique on both sides link; the rest goes on."""
    open_, done = left, []
    for name, keys in steps:
        one = right.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(right_id).alias(right_id)).filter("__n = 1").drop("__n")
        own = open_.groupBy(*keys).agg(F.count("*").alias("__m")).filter("__m = 1").drop("__m")
        hit = open_.join(own, keys, "left_semi").join(one, keys).select(left_id, right_id, F.lit(name).alias("method"))
        done.append(hit)
        open_ = open_.join(hit, left_id, "left_anti")
    linked = reduce(DataFrame.unionByName, done)
    return left.select(left_id).join(linked, left_id, "left").withColumn("status", F.when(F.col("method").isNotNull(), "enriched").otherwise("failed"))


def _blocks(rows: DataFrame, name: str, tokens_of, hot: DataFrame) -> DataFrame:
    """(name, __t): what a name is compared under: itself, each of its rarer tokens, and each two of its frequent ones."""
    each = rows.select(F.col(name).alias("__n"), F.explode(tokens_of(F.col(name))).alias("__t")).join(hot, "__t", "left")
    rare = each.filter("__hot is null").select("__n", "__t")
    some = each.filter("__hot").groupBy("__n").agg(F.sort_array(F.collect_set("__t")).alias("h"))
    two = F.flatten(F.transform("h", lambda x, i: F.transform(F.slice("h", i + 2, F.greatest(F.size("h") - i - 1, F.lit(0))), lambda y: F.concat(x, F.lit(" "), y))))
    itself = rows.select(F.col(name).alias("__n"), F.concat(F.lit("="), F.lower(name)).alias("__t"))
    return rare.union(some.select("__n", F.explode(two))).union(itself).distinct().withColumnRenamed("__n", name)


def best_by_similarity(names: DataFrame, registry: DataFrame, name: str, variant: str, score: Column, tokens_of, keep: int | None = 1, least: float = 0.6, frequent: int = 1000) -> DataFrame:
    """Top registry variants (keep None: all) per distinct name, among those that are equal but for case or share a token.

    A token that more than frequent variants hold doesn't make a pair by itself, only together with another shared one; so
    a word of all names costs no more than others. Ties: the least variant first.
    """
    a, b = names.select(name).filter(F.col(name).isNotNull()).distinct(), registry.select(variant).filter(F.col(variant).isNotNull()).distinct()
    hot = b.select(F.explode(tokens_of(F.col(variant))).alias("__t")).groupBy("__t").agg(F.count("*").alias("n")).filter(F.col("n") > frequent).select("__t", F.lit(True).alias("__hot"))
    pairs = _blocks(a, name, tokens_of, hot).join(_blocks(b, variant, tokens_of, hot), "__t").drop("__t").distinct()
    scored = pairs.withColumn("score", score).filter(F.col("score") >= least).join(registry, variant)
    if keep is None:
        return scored
    w = Window.partitionBy(name).orderBy(F.desc("score"), F.col(variant), *[c for c in registry.columns if c != variant])
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= keep)


def lookup(left: DataFrame, dimension: DataFrame, keys: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """left with columns of a table that holds each key once at most: names there to names here, all others by default.

    A column that left has keeps its own value where the table has none. Repeated keys of the table: the least row counts.
    """
    columns = columns or {c: c for c in dimension.columns if c not in keys}
    one = dimension.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("__d"))
    j = left.join(one, keys, "left")
    new = {here: F.coalesce(F.col(f"__d.{there}"), F.col(here)) if here in left.columns else F.col(f"__d.{there}") for there, here in columns.items()}
    return j.withColumns(new).select(*left.columns, *[c for c in columns.values() if c not in left.columns])


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last in the order, as one aggregate; of equal ones the greatest."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__r"))
    return top.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def recent_matches(matches: DataFrame, names: tuple[str, str] = ("player1_name", "player2_name")) -> DataFrame:
    """Every player's last match: player_id, match_id, date, opponent, round. matches: match_id, date, round, player1_id, player2_id."""
    side = lambda p: F.struct(F.col(f"player{p}_id").alias("player_id"), "date", "match_id", F.col(names[2 - p]).alias("opponent"), "round")
    return latest(matches.select(F.inline(F.array(side(1), side(2)))).filter("player_id is not null"), ["player_id"], ["date", "match_id"])
