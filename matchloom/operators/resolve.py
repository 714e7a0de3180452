"""Entity resolution: staged joins, each passing on what it leaves open; doubtful rows go to a review table.

Tournaments: known source id (its name must be alike, else review); exact name in the source; best similarity over registry
variants that share a token, by thresholds; create, in the level's range. Players: known source id; one exact name;
best similarity; create. Decisions that people made are a table that comes first, in place of prompts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import player_key, player_similarity, tournament_similarity, valid_player_name
from .linkage import best_by_similarity
from .tables import allocate_ids

STAGES = "source string, source_id string, name string"


def resolve(mentions: DataFrame, registry: DataFrame, *, score: Column, tokens_of, automatic: float, review: float, decisions: DataFrame | None = None, base: int = 100000) -> tuple[DataFrame, DataFrame]:
    """mentions (source, source_id, name), registry (entity_id, source, source_id, variant): (resolved, to review).

    resolved: mentions with entity_id, action (decided, linked_id, linked_name, linked_fuzzy, created) and score.
    """
    m = mentions.select("source", "source_id", "name").distinct()
    done = []
    if decisions is not None:
        hit = m.join(decisions.select("source", "source_id", F.col("entity_id")), ["source", "source_id"]).withColumns({"action": F.lit("decided"), "score": F.lit(1.0)})
        done.append(hit)
        m = m.join(hit.select("source", "source_id"), ["source", "source_id"], "left_anti")
    ids = registry.groupBy("source", "source_id").agg(F.min("entity_id").alias("entity_id"))
    hit = m.join(ids, ["source", "source_id"]).withColumns({"action": F.lit("linked_id"), "score": F.lit(1.0)})
    m = m.join(ids, ["source", "source_id"], "left_anti")
    done.append(hit)
    exact = registry.groupBy("source", F.lower("variant").alias("__n")).agg(F.min("entity_id").alias("entity_id"))
    keyed = m.withColumn("__n", F.lower("name"))
    done.append(keyed.join(exact, ["source", "__n"]).drop("__n").withColumns({"action": F.lit("linked_name"), "score": F.lit(1.0)}))
    m = keyed.join(exact, ["source", "__n"], "left_anti").drop("__n")
    best = best_by_similarity(m, registry.select("entity_id", "variant").distinct(), "name", "variant", score, tokens_of, keep=1, least=review).select("name", "entity_id", "score")
    best = best.groupBy("name").agg(F.min("entity_id").alias("entity_id"), F.max("score").alias("score"))
    near = m.join(best, "name")
    done.append(near.filter(F.col("score") >= automatic).withColumn("action", F.lit("linked_fuzzy")))
    doubtful = near.filter(F.col("score") < automatic)
    m = m.join(best.select("name"), "name", "left_anti")
    created = allocate_ids(registry.select("entity_id", F.col("variant").alias("name")), m, "entity_id", "name", base)
    done.append(m.join(created, "name").withColumns({"action": F.lit("created"), "score": F.lit(0.0)}))
    cols = ["source", "source_id", "name", "entity_id", "action", "score"]
    out = done[0].select(*cols)
    for d in done[1:]:
        out = out.unionByName(d.select(*cols))
    return out, doubtful.select("source", "source_id", "name", "entity_id", "score")


def quality_report(resolved: DataFrame) -> DataFrame:
    """Rows by action and their share in percent."""
    n = resolved.groupBy("action").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))), 2))


OUTCOME = ["source", "source_id", "name", "entity_id", "action", "confidence", "score"]


def _first(*stages: tuple[Column, Column, Column, Column, Column]) -> list[Column]:
    """entity_id, action, confidence and score of the first stage, in this order, whose condition (its first part) holds."""
    out = []
    for i, name in enumerate(("entity_id", "action", "confidence", "score"), 1):
        c = None
        for stage in stages:
            c = F.when(stage[0], stage[i]) if c is None else c.when(stage[0], stage[i])
        out.append(c.alias(name))
    return out


def _decided(m: DataFrame, decisions: DataFrame | None, kind) -> DataFrame:
    if decisions is None:
        return m.withColumn("__d", F.lit(None).cast(kind))
    return m.join(decisions.groupBy("source", "source_id").agg(F.min("entity_id").cast(kind).alias("__d")), ["source", "source_id"], "left")


def match_tournaments(mentions: DataFrame, registry: DataFrame, tokens_of, *, decisions: DataFrame | None = None, high: float = 0.8, review: float = 0.6, certain: float = 0.995) -> DataFrame:
    """A row per distinct mention (source, source_id, name, level): entity_id, action, confidence, score.

    registry: entity_id, source, source_id, variant. Actions: decided; known_id, or review_known_id if its best stored name
    is less alike than high; same_name_new_id; fuzzy from certain on; confirm from high, review from review on, with the best
    candidate; create_suggested, whose identifier registry.suggest_ids() gives by level. Every stage is a left join that
    adds its columns, and only names that the exact ones leave open are compared with variants.
    """
    kind = registry.schema["entity_id"].dataType
    m = _decided(mentions.select("source", "source_id", "name").distinct(), decisions, kind)
    ids = registry.groupBy("source", "source_id").agg(F.min("entity_id").alias("__i"))
    m = m.join(ids, ["source", "source_id"], "left")
    variants = registry.select("entity_id", "variant").distinct()
    known = m.filter("__d is null and __i is not null").select("name", "__i").distinct().join(variants.withColumnRenamed("entity_id", "__i"), "__i")
    known = known.withColumn("s", tournament_similarity(F.col("name"), F.col("variant"))).groupBy("__i", "name").agg(F.max("s").alias("__is"))
    m = m.join(known, ["__i", "name"], "left")
    exact = registry.groupBy("source", F.lower("variant").alias("__n")).agg(F.min("entity_id").alias("__e"))
    m = m.withColumn("__n", F.lower("name")).join(exact, ["source", "__n"], "left")
    names = m.filter("__d is null and __i is null and __e is null").select("name")
    best = best_by_similarity(names, variants, "name", "variant", tournament_similarity(F.col("name"), F.col("variant")), tokens_of, keep=1, least=review).select("name", F.col("entity_id").alias("__f"), F.col("score").alias("__fs"))
    m = m.join(best, "name", "left")
    text, s, t = F.lit, F.col("__is"), F.col("__fs")
    stages = [
        (F.col("__d").isNotNull(), F.col("__d"), text("decided"), text("high"), F.lit(1.0)),
        (F.col("__i").isNotNull(), F.col("__i"), F.when(s >= high, "known_id").otherwise("review_known_id"), F.when(s >= high, "high").otherwise("low"), s),
        (F.col("__e").isNotNull(), F.col("__e"), text("same_name_new_id"), text("high"), F.lit(1.0)),
        (F.col("__f").isNotNull(), F.col("__f"), F.when(t >= certain, "fuzzy").when(t >= high, "confirm").otherwise("review"), F.when(t >= certain, "high").when(t >= high, "medium").otherwise("low"), t),
        (F.lit(True), F.lit(None).cast(kind), text("create_suggested"), text("high"), F.lit(0.0)),
    ]
    return m.select("source", "source_id", "name", *_first(*stages)).select(*OUTCOME)


def match_players(mentions: DataFrame, registry: DataFrame, tokens_of, *, automatic: bool = False, decisions: DataFrame | None = None, high: float = 0.8, medium: float = 0.6, base: int = 100000) -> DataFrame:
    """A row per distinct mention (source, source_id, name): entity_id, action, confidence, score.

    Actions: error (no valid name); decided; linked_exact (known id of a name alike from high on, or one player of that very
    name); linked_fuzzy (automatic, from medium on); manual_needed, with the best candidate; created, numbered on.
    """
    kind = registry.schema["entity_id"].dataType
    m = _decided(mentions.select("source", "source_id", "name").distinct(), decisions, kind)
    m = m.withColumn("__bad", ~valid_player_name(F.col("name")) | F.coalesce(player_key(F.col("name")) == "", F.lit(True)))
    ids = registry.groupBy("source", "source_id").agg(F.min(F.struct("entity_id", "variant")).alias("__r")).select("source", "source_id", F.col("__r.entity_id").alias("__i"), F.col("__r.variant").alias("__v"))
    m = m.join(ids, ["source", "source_id"], "left").withColumn("__is", player_similarity(F.coalesce("name", F.lit("")), F.coalesce("__v", F.lit(""))))
    open_ = m.filter("not __bad and __d is null and __i is null").select("name").distinct()
    found = best_by_similarity(open_, registry.select("entity_id", "variant").distinct(), "name", "variant", player_similarity(F.col("name"), F.col("variant")), tokens_of, keep=None, least=0.3)
    per = found.groupBy("name", "entity_id").agg(F.max("score").alias("s"))
    best = per.groupBy("name").agg(F.max(F.struct("s", (-F.col("entity_id")).alias("e"))).alias("b"), F.count_if(F.col("s") >= 0.99).alias("__exact"))
    named = open_.join(best.select("name", (-F.col("b.e")).cast(kind).alias("__f"), F.col("b.s").alias("__fs"), "__exact"), "name", "left")
    new = allocate_ids(registry.select("entity_id", F.col("variant").alias("name")), named.filter("__f is null"), "entity_id", "name", base).select("name", F.col("entity_id").cast(kind).alias("__c"))
    m = m.join(named.join(new, "name", "left"), "name", "left")
    text, s, t = F.lit, F.col("__is"), F.col("__fs")
    exact, fuzzy = F.col("__exact") == 1, F.lit(automatic) & (t >= medium)
    stages = [
        (F.col("__bad"), F.lit(None).cast(kind), text("error"), text("low"), F.lit(0.0)),
        (F.col("__d").isNotNull(), F.col("__d"), text("decided"), text("high"), F.lit(1.0)),
        (F.col("__i").isNotNull(), F.col("__i"), F.when(s >= high, "linked_exact").otherwise("manual_needed"), F.when(s >= high, "high").otherwise("low"), s),
        (F.col("__f").isNotNull(), F.col("__f"), F.when(exact, "linked_exact").when(fuzzy, "linked_fuzzy").otherwise("manual_needed"), F.when(exact | (fuzzy & (t >= high)), "high").when(fuzzy, "medium").otherwise("low"), t),
        (F.lit(True), F.col("__c"), text("created"), text("high"), F.lit(0.0)),
    ]
    return m.select("source", "source_id", "name", *_first(*stages)).select(*OUTCOME)


def applied(df: DataFrame, outcome: DataFrame, *, source: str, source_id: str, name: str, into: str) -> DataFrame:
    """df with the resolved identifier in into (its own where nothing was resolved), and into_original, into_action, into_confidence."""
    o = outcome.select(F.col("source").alias("__s"), F.col("source_id").alias("__i"), F.col("name").alias("__n"), F.col("entity_id").alias("__e"), F.col("action").alias(f"{into}_action"), F.col("confidence").alias(f"{into}_confidence"))
    j = df.join(o, (F.col(source) == F.col("__s")) & (F.col(source_id).cast("string") == F.col("__i")) & F.col(name).eqNullSafe(F.col("__n")), "left")
    held = F.col(source_id) if into not in df.columns else F.col(into)
    resolved = F.when(F.col(f"{into}_action").isin("manual_needed", "review", "confirm", "review_known_id", "error"), None).otherwise(F.col("__e"))
    return j.withColumn(f"{into}_original", F.col(source_id)).withColumn(into, F.coalesce(resolved.cast("string"), held.cast("string"))).drop("__s", "__i", "__n", "__e")
