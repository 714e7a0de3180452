"""The corpus pipeline: toxicity, quality rules, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the shared folder and
rereads as the next stage's docs. All stages but the last return the columns of documents.

Verdicts belong to rows, not to ids: ids may be null or repeat, over equal or over different texts, and every row is
judged by what it holds itself. Columns of documents may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import bpe, decontaminate, minhash, quality, toxicity
from matchloom.llm.common import drop, table, written


def _apart(docs: DataFrame) -> DataFrame:
    """docs whose further columns can't clash with what an operator adds."""
    return docs.toDF(*[c if c in ("doc_id", "text", "n_chars") else f"__own_{c}" for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go.

    Null and empty texts stay; repeated rows are judged alike; a text counts whole, however long; no label, none go.
    """
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    apart = _apart(docs)
    return toxicity.score(apart, chain).filter("not is_toxic").select(*apart.columns).toDF(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, each by its own text, whatever its id.

    Null and empty texts go (they have too few words); null languages and sources are groups of their own.
    """
    return quality.accepted(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one row stays: that of the least id (null ids last), of equal ids the least text's.

    Rows are compared by their texts alone: repeated rows become one, and of two texts under one id both stay unless they
    are near-duplicates. Empty texts are a class like others; null texts are compared with nothing, and all stay.
    """
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")  # written once, so numbers hold
    classes = minhash.classes(numbered.select("__row", "text"), id_col="__row").withColumnRenamed("doc_id", "__row")
    named = numbered.select("__row", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text")).join(classes, "__row")
    least = named.groupBy("class_id").agg(F.min(F.struct(F.col("__id").isNull().alias("n"), "__id", "__text", "__row")).alias("least"))
    return numbered.join(least.select(F.col("least.__row").alias("__row")), "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark passages are cut out; a document that was nothing else goes.

    Null and empty texts stay; an empty benchmark cuts nothing; n_chars is counted anew where something was cut.
    """
    return decontaminate.scan(_apart(docs), table(spark, sf_dir, "benchmark"), cut=True).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to, one row per row; null texts count as empty."""
    return bpe.digests(bpe.encode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near duplicates", one_of_each_class),
    ("decontamination", cut_benchmarks),
    ("byte-level BPE", encode),
]

#: Classifier chain, robust scatter and BPE have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop(before)
    return docs
