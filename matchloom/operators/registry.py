"""Registers of entities and of matches already processed: free ids, search, coverage, doubtful variants, removal, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import LEVEL_RANGES, id_fits_level


def lowest_free_ids(registry: DataFrame, id_col: str) -> DataFrame:
    """(level, free_id): the lowest identifier of each level's range that the registry lacks; a full range gives null.

    Ranges are fixed, a few thousand numbers in all, so the registry is only asked which of them it holds.
    """
    spark = registry.sparkSession
    ranges = spark.createDataFrame([(k, *v) for k, v in LEVEL_RANGES.items()], "level string, low int, high int")
    every = ranges.select("level", F.explode(F.sequence("low", "high")).alias("free_id"))
    free = every.join(registry.select(F.col(id_col).cast("int").alias("free_id")).distinct(), "free_id", "left_anti").groupBy("level").agg(F.min("free_id").alias("free_id"))
    return ranges.select("level").join(free, "level", "left")


def suggest_ids(new: DataFrame, registry: DataFrame, source_id: str, level: str, id_col: str) -> DataFrame:
    """new with suggested_id: its own source id if that fits the level and is free, else the level's lowest free one."""
    taken = registry.select(F.col(id_col).cast("int").alias("__id")).distinct().withColumn("__taken", F.lit(True))
    own = F.when(id_fits_level(F.col(source_id), F.col(level)), F.col(source_id).try_cast("int"))
    free = lowest_free_ids(registry, id_col).withColumnRenamed("level", "__level")
    known = F.when(F.upper(level).isin(*LEVEL_RANGES), F.upper(level)).otherwise("C")
    j = new.withColumns({"__id": own, "__level": known}).join(taken, "__id", "left").join(F.broadcast(free), "__level", "left")  # a row per level
    return j.withColumn("suggested_id", F.when(F.col("__id").isNotNull() & F.col("__taken").isNull(), F.col("__id")).otherwise(F.col("free_id"))).select(*new.columns, "suggested_id")


def search(registry: DataFrame, name: str, wanted: str, least: float = 0.3, top: int = 20) -> DataFrame:
    """Names that hold the wanted text, similarity 1.0 if equal, else 0.7; at most top of them."""
    low, w = F.lower(F.col(name)), wanted.lower()
    found = registry.filter(low.contains(w)).withColumn("similarity", F.when(low == w, 1.0).otherwise(0.7)).filter(F.col("similarity") >= least)
    return found.orderBy(F.desc("similarity"), name).limit(top)


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the percentage of rows in which each column is filled."""
    return df.agg(*[F.round(F.avg(F.col(c).isNotNull().cast("double")) * 100, 2).alias(c) for c in columns])


def missing(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that lack something, and what."""
    out = df.select(key, F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])).alias("missing"))
    return out.filter(F.size("missing") > 0)


def ambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, and these, sorted."""
    return df.select(key, value).distinct().groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(value)).filter(F.size(value) > 1)


def closest_rank(names: DataFrame, players: DataFrame, keys: list[str], rank: str, player_id: str, row_id: str) -> DataFrame:
    """row_id and the player of the same keys whose rank is nearest; of equally near ones the least id.

    Both sides in one order of keys and rank: the nearest is the last player up to a row or the first from it on, so
    that a key of many names and players costs a sort of them, not their product.
    """
    least = players.groupBy(*keys, F.col(rank).alias("__rank")).agg(F.min(player_id).alias("__player")).filter("__rank is not null")
    rows = names.filter(F.col(rank).isNotNull()).select(*keys, F.col(rank).alias("__rank"), F.col(row_id).alias("__row"), F.lit(None).cast(least.schema["__player"].dataType).alias("__player"))
    both = rows.unionByName(least.withColumn("__row", F.lit(None).cast(rows.schema["__row"].dataType)))
    held = F.when(F.col("__player").isNotNull(), F.struct("__rank", "__player"))
    w = Window.partitionBy(*keys).orderBy("__rank")
    near = both.withColumns({"a": F.last(held, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0)), "b": F.first(held, ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))})
    gap = lambda c: F.abs(F.col("__rank") - F.col(f"{c}.__rank"))
    pick = lambda c: F.when(F.col(c).isNotNull(), F.struct(gap(c).alias("gap"), F.col(f"{c}.__player").alias("p")))
    found = near.filter("__player is null").withColumn("best", F.least(pick("a"), pick("b"))).filter("best is not null")
    return found.select(F.col("__row").alias(row_id), F.col("best.p").alias(player_id), F.col("best.gap").alias("gap"))


def doubtful_variants(registry: DataFrame, entity: str, variant: str, score, below: float = 0.6, names: int = 64) -> DataFrame:
    """Pairs (first, second) of an entity's variants that are less alike than below: all pairs are compared.

    An entity's distinct names are dealt into blocks of at most names; a task compares two blocks, so that an entity of very
    many names, whose check costs their square whatever one does, is shared by many tasks.
    """
    v = registry.select(entity, variant).filter(F.col(variant).isNotNull()).distinct()
    size = v.groupBy(entity).agg(F.count("*").alias("__size")).filter("__size > 1").withColumn("__blocks", F.ceil(F.col("__size") / names).cast("int"))
    v = v.join(size, entity).withColumn("__b", F.pmod(F.xxhash64(variant), F.col("__blocks")).cast("int"))
    a = v.select(entity, F.col(variant).alias("first"), F.col("__b").alias("x"), F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("y"))
    b = v.select(entity, F.col(variant).alias("second"), F.col("__b").alias("y"), F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("x"))
    pairs = a.join(b, [entity, "x", "y"]).filter("first < second").select(entity, "first", "second")
    return pairs.withColumn("similarity", score(F.col("first"), F.col("second"))).filter(F.col("similarity") < below)


def issues(doubtful: DataFrame, entity: str) -> DataFrame:
    """One row per entity with doubtful pairs: how many, and the least alike."""
    return doubtful.groupBy(entity).agg(F.count("*").alias("pairs"), F.min(F.struct("similarity", "first", "second")).alias("w")).select(entity, "pairs", F.col("w.similarity").alias("least"), F.col("w.first").alias("first"), F.col("w.second").alias("second"))


def remove_matches(events: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Events of these matches leave the history, by identifier: two matches may share an order key."""
    return events.join(gone.select(key).distinct(), key, "left_anti")


def before_key(events: DataFrame, key: Column, kk: str = "kk") -> DataFrame:
    """History cut off at an order key, which goes itself."""
    return events.filter(F.col(kk) < key)


def processed_counts(match_ids: DataFrame, match_id: str) -> DataFrame:
    """Matches per event, year and round, read from their identifiers."""
    part = lambda a, n, name: F.substring(match_id, a, n).alias(name)
    return match_ids.select(match_id).distinct().groupBy(part(1, 4, "tourney"), part(5, 2, "year"), part(7, 3, "round")).agg(F.count("*").alias("n"))


def event_status(events: DataFrame, processed: DataFrame, event_id: str, end_date: str, year: Column, today: Column) -> DataFrame:
    """events with final_processed, status and priority. processed: as processed_counts() gives it."""
    finals = processed.filter("round = '002'").select(F.col("tourney").alias("__t"), F.col("year").alias("__y")).distinct().withColumn("__f", F.lit(True))
    e = events.withColumns({"__t": F.format_string("%04d", F.col(event_id).cast("int")), "__y": F.format_string("%02d", F.pmod(year, F.lit(100)).cast("int"))}).join(finals, ["__t", "__y"], "left")
    done, known = F.coalesce("__f", F.lit(False)), F.col(end_date).isNotNull() & F.col(event_id).isNotNull()
    ladder = lambda a, b, c, d: F.when(~known, d).when(done, a).when(F.col(end_date) < today, b).otherwise(c)
    return e.withColumns({"final_processed": done & known, "status": ladder("Processed", "Finished - Needs Processing", "Ongoing", "Unknown"), "priority": ladder("None", "High", "Medium", "Low")}).drop("__t", "__y", "__f")


def adjusted_dates(matches: DataFrame, date: str = "tourney_date", keys: tuple[str, ...] = ("tourney_id",)) -> Column:
    """The event's first date and a day a round."""
    days = F.create_map(*[F.lit(x) for pair in {"R128": 0, "R64": 1, "R32": 2, "R16": 3, "QF": 4, "SF": 5, "F": 6, "RR": 7}.items() for x in pair])
    return F.date_add(F.min(date).over(Window.partitionBy(*keys)), F.coalesce(F.element_at(days, F.col("round")), F.lit(0)))


def rating_history(ratings: DataFrame, players: list[int] | None = None, rating_type: str = "general") -> DataFrame:
    """Ratings in order, with the round read from the order key."""
    h = ratings.filter(F.col("rating_type") == rating_type)
    h = h.filter(F.col("player_id").isin(players)) if players is not None else h
    return h.withColumn("round_order", (2048 - F.pmod(F.col("kk"), F.lit(4096))).cast("int")).select("player_id", "kk", "seq", "round_order", "pre", "post")


def bet_summary(results: DataFrame, by: str = "strategy") -> DataFrame:
    """Bets, wins, losses, profit, stake, return, and predicted and realised edge with their deviations (n - 1)."""
    realised = F.try_divide(F.col("profit"), F.col("stake"))
    return results.groupBy(by).agg(
        F.count("*").alias("bets"), F.count_if(F.col("won") == 1).alias("wins"), F.count_if(F.col("won") != 1).alias("losses"), F.sum("profit").alias("profit"), F.sum("stake").alias("staked"),
        F.try_divide(F.sum("profit") * 100, F.sum("stake")).alias("roi"), F.avg("ev").alias("edge"), F.stddev_samp("ev").alias("edge_sd"), F.avg(realised).alias("realised"), F.stddev_samp(realised).alias("realised_sd"),
    )


def by_source(entities: DataFrame, sources: DataFrame, entity: str, *, source=None, source_id=None) -> DataFrame:
    """Entities with their source rows; of one source, or of one id in it."""
    s = sources
    if source is not None:
        s = s.filter(F.col("source") == F.lit(source))
    if source_id is not None:
        s = s.filter(F.col("source_id") == F.lit(source_id))
    return entities.join(s, entity)


def info(entities: DataFrame, sources: DataFrame, entity: str) -> DataFrame:
    """One row per entity: its columns, how many sources name it, their names and variants, sorted."""
    s = sources.groupBy(entity).agg(F.countDistinct("source").alias("sources"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("source_names"), F.sort_array(F.collect_set("variant")).alias("variants"))
    return entities.join(s, entity, "left").withColumns({"sources": F.coalesce("sources", F.lit(0)), "variants": F.coalesce("variants", F.array().cast("array<string>"))})


def add_source(sources: DataFrame, new: DataFrame, entity: str) -> DataFrame:
    """Source rows with the new ones whose (source, source_id) is free; of several new ones the least entity's."""
    one = new.groupBy("source", "source_id").agg(F.min(F.struct(entity, "variant")).alias("r")).select("source", "source_id", "r.*")
    return sources.unionByName(one.join(sources.select("source", "source_id"), ["source", "source_id"], "left_anti").select(*sources.columns))


def load_players(raw: DataFrame, *, today: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(players, rejected) from a table of strings player_id, player_name (or name_first, name_last), dob, hand, height.

    Ids of six digits and names of 1 to 50 characters enter, the first row of an id in the order of all its cells; what
    isn't a valid date of birth, hand or height is null.
    """
    from ..functions.scalars import valid_dob, valid_hand, valid_height
    from ..functions.similarity import player_key

    name = F.trim("player_name") if "player_name" in raw.columns else F.trim(F.concat_ws(" ", "name_first", "name_last"))
    cell = lambda c: F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select(F.trim(cell("player_id")).try_cast("double").try_cast("long").alias("player_id"), name.alias("name"), *[cell(c).alias(c) for c in ("dob", "hand", "height")])
    good = F.coalesce(F.col("player_id").between(100000, 999999) & F.length("name").between(1, 50), F.lit(False))
    one = rows.filter(good).groupBy("player_id").agg(F.min(F.struct("name", "dob", "hand", "height")).alias("r")).select("player_id", "r.*")
    players = one.select("player_id", F.col("name").alias("primary_name"), player_key(F.col("name")).alias("preprocessed_name"), valid_dob(F.col("dob"), today).alias("dob"), valid_hand(F.col("hand")).alias("hand"), valid_height(F.col("height")).alias("height"))
    return players, rows.filter(~good)


def metadata_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: rows, filled, and the share filled in percent."""
    one = df.agg(F.count("*").alias("n"), *[F.count(c).alias(f"__{i}") for i, c in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("rows"), F.col(f"__{i}").alias("filled")) for i, c in enumerate(columns)])
    return one.select(F.inline(each)).withColumn("percent", F.round(F.try_divide(F.col("filled") * 100.0, F.col("rows")), 2))


def events_summary(events: DataFrame, player: str = "player_id") -> DataFrame:
    """One row: players, matches (events are two a match), and the average, greatest and least number of a player's events."""
    per = events.groupBy(player).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("players"), F.floor(F.sum("n") / 2).alias("matches"), F.avg("n").alias("average"), F.max("n").alias("most"), F.min("n").alias("fewest"))
