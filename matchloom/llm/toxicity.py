"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over the presence of words; a later model also sees
the probabilities of the earlier categories. In training those are out-of-fold predictions, so that a later model meets
inputs as uncertain as it will meet when scoring.

Training takes a bounded sample of labelled rows, sample_rows (documented parameter): half of them positive in the last
category if there are as many, chosen by a hash of the id. The sample is written once. Its words are counted per
category by a partial aggregate, and the max_terms words that tell most come to the driver, with a bit per sampled
row and such word; so what the driver holds is bounded by these two parameters, however long the texts are. Scoring goes
over all texts in one narrow pass; what is broadcast is the model, of at most max_terms words.

Cases: null or empty text: no words, the intercepts' probabilities. Null labels: not toxic. Repeated ids in labels: the
highest label counts; repeated documents train once and are each scored. Empty labels or one class only: a constant
model that finds nothing toxic. Very long texts: each word counts once. Columns of docs pass through and clashing
ones (p_..., is_toxic) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, small_batches, written
from .tokens import Lookup, Words, alnum_mask, arrow_bytes

#: Words that tell which kind of abuse a toxic text holds; weak labels of the first two categories.
INSULT_WORDS = ["idiot", "moron", "loser", "clown", "scum", "trash"]
CONTEMPT_WORDS = ["stupid", "pathetic", "worthless", "disgusting"]


@dataclass
class Chain:
    """categories in order; terms: sorted word hashes; weights[c]: of terms, then of earlier probabilities; biases."""

    categories: list[str]
    terms: np.ndarray
    weights: list[np.ndarray]
    biases: list[float]

    def probabilities(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """n x categories, from distinct (doc, term) pairs."""
        out = np.zeros((n, len(self.categories)))
        for c, (w, b) in enumerate(zip(self.weights, self.biases)):
            z = b + np.bincount(doc, weights=w[term], minlength=n) + out[:, :c] @ w[len(self.terms) :]
            out[:, c] = _sigmoid(z)
        return out


def _fit(x: np.ndarray, y: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge, by Newton steps."""
    n, d = x.shape
    if not n or y.min() == y.max():
        return np.zeros(d), -40.0 if not n or y.max() == 0 else 40.0
    x = np.column_stack([x, np.ones(n)])
    ridge = np.append(np.full(d, l2), 1e-3)
    w = np.zeros(d + 1)
    for _ in range(12):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _chain(x: np.ndarray, terms: np.ndarray, labels: np.ndarray, folds: np.ndarray, categories: list[str], l2: float) -> Chain:
    """x: rows by terms, 0 or 1. Each category's model sees the terms and the earlier categories' out-of-fold probabilities."""
    weights, biases = [], []
    for c in range(len(categories)):
        y, oof = labels[:, c].astype(float), np.zeros(len(x))
        for f in np.unique(folds):
            out = folds == f
            w, b = _fit(x[~out], y[~out], l2)
            oof[out] = _sigmoid(x[out] @ w + b)
        w, b = _fit(x, y, l2)
        weights.append(w)
        biases.append(b)
        x = np.column_stack([x, oof])
    return Chain(categories, terms, weights, biases)


def _telling(n: Column, of: Column, rows: float, positive: float) -> Column:
    """Root of the likelihood ratio of a word in n of rows, of of them among the positive ones."""
    share = positive / rows
    part = lambda k, m: F.when(k > 0, k * F.log(k / m)).otherwise(0.0)
    return F.sqrt(F.greatest(F.lit(0.0), (part(of, n * share) + part(n - of, n * (1 - share))) * 2))


def fit(docs: DataFrame, labels: DataFrame, *, categories: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 6000, max_terms: int = 512, least_score: float = 5.5, folds: int = 5, l2: float = 0.5) -> Chain:
    """categories: names and, per name, a condition on text and label_col, in the chain's order.

    Words enter if the root of their likelihood ratio is least_score or more in some category (chance alone gives about
    5 to the luckiest of a million words), the max_terms most telling ones of them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if categories is None:
        has = lambda words: F.col(text_col).rlike(r"(?i)\b(" + "|".join(words) + r")\b") & (F.col(label_col) == 1)
        categories = {"insult": has(INSULT_WORDS), "contempt": has(CONTEMPT_WORDS), "toxic": F.col(label_col) == 1}
    flags = labels.select(F.col(id_col).alias("__id"), F.coalesce(F.col(label_col).cast("int"), F.lit(0)).alias("__label")).filter("__id is not null").groupBy("__id").agg(F.max("__label").alias("__label"))
    order = [F.xxhash64("__id"), F.col("__id")]
    chosen = flags.filter("__label = 1").orderBy(*order).limit(sample_rows // 2).union(flags.filter("__label != 1").orderBy(*order).limit(sample_rows // 2))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias(text_col)).join(F.broadcast(chosen), "__id")  # at most sample_rows ids
    rows = rows.withColumn(label_col, F.col("__label")).select("__id", text_col, *[F.coalesce(c, F.lit(False)).cast("int").alias(f"__c{i}") for i, c in enumerate(categories.values())], F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(folds)).cast("int").alias("__fold"))
    names = [f"__c{i}" for i in range(len(categories))]
    # repeated documents train once: of one id the least text
    sample = written(rows.groupBy("__id").agg(F.min_by(F.struct(text_col, *names, "__fold"), F.struct(F.xxhash64(text_col), text_col)).alias("r")).select("__id", "r.*"), "sample")
    total = sample.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(alnum_mask())
        for b in batches:
            hashes, _, _, first = split(*arrow_bytes(b[text_col]))
            sets = [np.unique(hashes[first[i] : first[i + 1]]) for i in range(b.num_rows)]
            row = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in sets]))
            yield pa.RecordBatch.from_arrays([*[b[c].take(row) for c in names], pa.array(np.concatenate(sets or [np.zeros(0, np.uint64)]).astype(np.int64))], names=[*names, "term"])

    found = sample.select(text_col, *names).mapInArrow(words, ", ".join([*[f"{c} int" for c in names], "term long"]))
    counts = found.groupBy("term").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names])
    scores = [_telling(F.col("n"), F.col(c), float(total["n"]), float(total[c])) for c in names if 0 < total[c] < total["n"]]
    terms = np.zeros(0, np.uint64)
    if scores:
        best = counts.withColumn("score", F.greatest(*scores, F.lit(0.0))).filter(F.col("score") >= least_score).orderBy(F.desc("score"), "term").limit(max_terms)
        terms = np.sort(np.array([r["term"] for r in best.select("term").collect()], np.int64).astype(np.uint64))

    schema = T.StructType([*[T.StructField(c, T.IntegerType()) for c in (*names, "__fold")], T.StructField("bits", T.BinaryType())])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lookup = Words(alnum_mask()), Lookup(terms)
        for b in batches:
            hashes, _, _, first = split(*arrow_bytes(b[text_col]))
            place = lookup(hashes)
            out = []
            for i in range(b.num_rows):
                has_term = np.zeros(len(terms) + 1, bool)
                has_term[place[first[i] : first[i + 1]]] = True
                out.append(np.packbits(has_term[1:]).tobytes())
            yield pa.RecordBatch.from_arrays([*[b[c] for c in (*names, "__fold")], pa.array(out, pa.binary())], names=schema.names)

    got = sample.orderBy("__id").select(text_col, *names, "__fold").mapInArrow(bits, schema).toPandas()
    x = np.array([np.unpackbits(np.frombuffer(r, np.uint8), count=len(terms)) for r in got["bits"]], float).reshape(len(got), len(terms))
    drop(sample)
    return _chain(x, terms, got[names].to_numpy().reshape(len(got), len(names)), got["__fold"].to_numpy(), list(categories), l2)


def score(docs: DataFrame, chain: Chain, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs, p_<category> double for each, and is_toxic: the last category's probability reaches threshold."""
    spark = docs.sparkSession
    small_batches(spark)
    added = [*[f"p_{c}" for c in chain.categories], "is_toxic"]
    docs = docs.drop(*[c for c in added if c in docs.columns])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(f"p_{c}", T.DoubleType()) for c in chain.categories], T.StructField("is_toxic", T.BooleanType())])
    model = spark.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, m = Words(alnum_mask()), model.value
        lookup, d = Lookup(m.terms), max(1, len(m.terms))
        for b in batches:
            words, _, _, first = split(*arrow_bytes(b[text_col]))
            term = lookup(words)
            at = np.flatnonzero(term)
            doc = np.searchsorted(first, at, "right") - 1
            pairs = np.unique(doc * d + term[at] - 1)
            p = m.probabilities(pairs // d, pairs % d, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(p[:, c]) for c in range(p.shape[1])], pa.array(p[:, -1] >= threshold)], names=schema.names)

    return docs.mapInArrow(run, schema)
