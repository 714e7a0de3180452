"""As-of statistics: what a series held strictly before the current key, tie-safe and sparse-safe.

Rows of one entity with equal keys don't see each other; a null value takes no place among the last k. Every helper is
a window over one partitioning, so that a feature table sorts each entity's events once. kk is an order number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNBOUNDED = Window.unboundedPreceding
#: kk is date * DAY + tourney * TOURNEY + 2048 - round.
DAY, TOURNEY = 1 << 43, 1 << 12


def order_number(date: Column, tourney: Column, round_order: Column) -> Column:
    """Larger means later: by date, then tournament, then round, as rounds fall through a draw; what is null comes last.

    Days since 1900 (17 bits), a tournament of up to 31 bits and a round of up to 2048. A number made from the key itself
    orders like the key; no global rank, so no single-task window and no join.
    """
    day = F.coalesce(F.datediff(date, F.lit("1900-01-01").cast("date")), F.lit((1 << 17) - 1)).cast("long")
    return day * DAY + F.coalesce(tourney.cast("long"), F.lit((1 << 31) - 1)) * TOURNEY + (2048 - F.coalesce(round_order.cast("long"), F.lit(-1)))


def order_key(df: DataFrame, date: str = "tourney_date", tourney: str = "tourney_id", round_order: str = "round_order") -> DataFrame:
    return df.withColumn("kk", order_number(F.col(date), F.col(tourney), F.col(round_order)))


def before(*keys: str) -> "Window":
    """All rows of the same keys with a strictly smaller kk."""
    return Window.partitionBy(*keys).orderBy("kk").rangeBetween(UNBOUNDED, -1)


def prior_sum(value: Column, *keys: str) -> Column:
    return F.coalesce(F.sum(value).over(before(*keys)), F.lit(0))


def prior_count(*keys: str) -> Column:
    return F.count(F.lit(1)).over(before(*keys))


def prior_latest(value: Column, *keys: str) -> Column:
    """The last non-null value strictly before: of rows that tie, the later to arrive."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct("kk", "seq"))).over(before(*keys))


def last_k(df: DataFrame, keys: list[str], series: dict[str, tuple[Column, tuple[int, ...], str]]) -> DataFrame:
    """df and name_k for each series name: (value, ks, how): of the last k non-null values strictly before, avg, sum, or
    gradient, their mean slope (0 for a single one). Null without any.

    All series share one sort by keys, kk and seq. A running total at each non-null value, less that of k values before,
    is what the last k come to; a row takes that of the last value before the first row of its own key.
    """
    part = ", ".join(f"`{k}`" for k in keys)
    skip = lambda c, k: F.expr(f"lag({c}, {k}) IGNORE NULLS OVER (PARTITION BY {part} ORDER BY kk, seq)")
    running = Window.partitionBy(*keys).orderBy("kk", "seq").rowsBetween(UNBOUNDED, 0)
    number = {n: i for i, n in enumerate(series)}
    own = df.columns
    df = df.withColumns({f"__v{number[n]}": v for n, (v, _, _) in series.items()})
    totals = {}
    for n, (_, _, how) in series.items():
        v, i = F.col(f"__v{number[n]}"), number[n]
        totals[f"__c{i}"] = F.count(v).over(running)
        totals[f"__t{i}"] = F.first(v, ignorenulls=True).over(running) if how == "gradient" else F.sum(v).over(running)
    df = df.withColumns(totals)
    df = df.withColumns({f"__t{i}": F.when(F.col(f"__v{i}").isNotNull(), F.col(f"__t{i}")) for n, i in number.items() if series[n][2] != "gradient"})
    places = [(n, k) for n, (_, ks, _) in series.items() for k in ks]
    lags = {}
    for j, (n, k) in enumerate(places):
        gradient = series[n][2] == "gradient"
        if not gradient or k > 1:
            lags[f"__l{j}"] = skip(f"__v{number[n]}", k - 1) if gradient else skip(f"__t{number[n]}", k)
    df = df.withColumns(lags)
    posts = {}
    for j, (n, k) in enumerate(places):
        i, how = number[n], series[n][2]
        v, size = F.col(f"__v{i}"), F.least(F.col(f"__c{i}"), F.lit(k))
        if how == "gradient":
            post = F.when(size >= 2, (v - F.coalesce(f"__l{j}", f"__t{i}")) / (size - 1)).otherwise(0.0) if k > 1 else F.lit(0.0)
        else:
            post = F.col(f"__t{i}") - F.coalesce(F.col(f"__l{j}"), F.lit(0))
            post = post / size if how == "avg" else post
        posts[f"__p{j}"] = F.when(v.isNotNull(), post)
    df = df.withColumns(posts).select(*own, *posts)
    df = df.withColumns({f"__p{j}": skip(f"__p{j}", 1) for j in range(len(places))})
    first = Window.partitionBy(*keys, "kk").orderBy("seq").rowsBetween(UNBOUNDED, 0)
    df = df.withColumn("__first", F.first(F.struct(*posts)).over(first))
    return df.select(*own, *[F.col(f"__first.__p{j}").alias(f"{n}_{k}") for j, (n, k) in enumerate(places)])


def nan_safe_diff(a: Column, b: Column) -> Column:
    """a - b; with one side missing, the other alone; null when both are."""
    return F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def day_window(days: int, key: str, offsets: int = 8, played: Column | None = None) -> Column:
    """Events strictly before the key whose deduced date (tourney_date + off days) is at most days before tourney_date.

    All events before the key, less those whose deduced date is earlier; these come before the key anyhow. A row's own
    deduced date is off days behind its date, so the frame's end follows off, one running frame for each of its values.
    Needs columns d (day number), off and kk.
    """
    played = F.lit(1) if played is None else played
    older = F.lit(0)
    for o in range(offsets):
        w = Window.partitionBy(key).orderBy(F.col("d") + F.col("off")).rangeBetween(UNBOUNDED, -(days + o + 1))
        older = F.when(F.col("off") == o, F.coalesce(F.sum(played).over(w), F.lit(0))).otherwise(older)
    return prior_sum(played, key) - older
