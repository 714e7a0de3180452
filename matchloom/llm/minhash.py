"""Near-duplicate classes by Order MinHash.

A text's k-mers are its runs of k words, each labelled with how often it has occurred before. A sketch entry takes,
under one hash function, the ell k-mers of least hash, in the order in which they stand in the text: two texts share it
with a probability that follows their order-preserving similarity. Texts that share an entry are candidates.

Candidates are verified by banded alignment: labelled k-mers of both texts are matched one to one, matches off the
diagonal by more than similarity allows are left out (they would leave too many unmatched), and the longest common
order is taken. Similarity is its length over that of the union; pairs of similarity or more are links.

A bucket of texts that share an entry is not expanded into its pairs. One of its texts leads and is compared with all
others. Buckets whose texts are of one class then are done. The texts of the others are dealt anew, by their rarest
labelled k-mers: texts of similarity or more share one of these (prefix filter; of two texts the shorter one needs fewer),
texts that only share a frequent passage don't. There several texts of a bucket lead, then ever more, until all have led
or are of one class; texts that are linked already, over whatever others, or that are too unlike in length and in the
place of what they share, need no comparison. Those with the most frequent k-mers lead first, as the original of many
copies does. So every pair that shares an entry is linked, compared or can't be similar; no bucket is dropped or cut for
its size. Texts that share rare k-mers, aren't alike and aren't linked over others are all compared with one another.
Equal texts are one node from the start. Classes are the connected components of the links, named by their least id; each
round's links are joined to the classes so far, not to the links so far.

Cases: texts of fewer than k words have one k-mer, the whole text. Null texts and texts without words: a class with
texts that are byte for byte equal; null by itself, each row its own class. Null ids are left out of classes (class
null). Repeated rows: one class. Empty table: no rows. Words are compared in lower case (A-Z), without punctuation.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, small_batches, written
from .graph import components
from .tokens import Words, alnum_mask, arrow_bytes, mix

_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def kmers(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of runs of k words; of a shorter text, one of all its words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h = mix(h * _STEP + words[j : n - k + 1 + j] + np.uint64(k))
    return h


def labelled(h: np.ndarray) -> np.ndarray:
    """k-mers joined with the number of their earlier occurrences."""
    if len(h) < 2:
        return h
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return h
    order = np.argsort(h, kind="stable")
    s = h[order]
    begin = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.arange(len(h))
    earlier = at - np.maximum.accumulate(np.where(begin, at, 0))
    out = h.copy()
    out[order] = np.where(earlier > 0, mix(s + earlier.astype(np.uint64) * _STEP), s)
    return out


def sketch(labels: np.ndarray, entries: int, ell: int) -> np.ndarray:
    """Order MinHash: per hash function, one number for the ell least k-mers in text order."""
    ell = min(ell, len(labels))
    if not ell:
        return np.zeros(0, np.int64)
    seeds = np.arange(1, entries + 1, dtype=np.uint64)
    least = np.empty((entries, ell), np.uint64)
    step = max(1, (1 << 20) // len(labels))
    for lo in range(0, entries, step):
        x = mix(labels[None, :] + (seeds[lo : lo + step] * np.uint64(0x632BE59BD9B4E019))[:, None])
        at = np.sort(np.argpartition(x, ell - 1, axis=1)[:, :ell], axis=1)
        least[lo : lo + step] = labels[at]
    h = seeds
    for j in range(ell):
        h = mix(h * _STEP + least[:, j])
    return h.astype(np.int64)


def alignment(a: np.ndarray, b: np.ndarray, similarity: float) -> float:
    """Similarity of two texts' labelled k-mers by banded alignment; -1 if it can't reach similarity."""
    na, nb = len(a), len(b)
    if not na or not nb:
        return 1.0 if na == nb else -1.0
    need = similarity / (1 + similarity) * (na + nb)  # m / (na + nb - m) >= similarity
    if min(na, nb) < need - 1e-9:
        return -1.0
    if na == nb and (a == b).all():
        return 1.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(ia) < need - 1e-9:
        return -1.0
    band = na + nb - 2 * need + 1
    near = np.abs(ia - ib) <= band
    ia, ib = ia[near], ib[near]
    ib = ib[np.argsort(ia)]
    if len(ib) and (np.diff(ib) > 0).all():
        m = len(ib)
    else:
        tails: list[int] = []
        for x in ib.tolist():
            at = bisect_left(tails, x)
            if at == len(tails):
                tails.append(x)
            else:
                tails[at] = x
        m = len(tails)
    return m / (na + nb - m) if m >= need - 1e-9 else -1.0


def _sketches(docs: DataFrame, id_col: str, text_col: str, k: int, entries: int, ell: int) -> DataFrame:
    """doc_id, key (equal for equal texts), sketch, size (number of k-mers); texts without words have an empty sketch."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("key", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("size", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(alnum_mask())
        for b in batches:
            words, _, _, first = split(*arrow_bytes(b["text"]))
            out, keys, sizes = [], [], []
            for i in range(b.num_rows):
                w = words[first[i] : first[i + 1]]
                labels = labelled(kmers(w, k))
                out.append(sketch(labels, entries, ell))
                sizes.append(len(labels))
                keys.append(_key(w) if len(w) else b"\0" + b["text"][i].as_py().encode())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(keys, pa.binary()), lists, pa.array(sizes, pa.int32())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _key(words: np.ndarray) -> bytes:
    """128 bits of the sequence of words."""
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    one = np.add.reduce(mix(words + at * _STEP))
    two = np.add.reduce(mix(words ^ mix(at * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1))))
    return b"\1" + np.array([one, two, len(words)], np.uint64).tobytes()


def _word_table(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, words): 32-bit hashes of the words of the named texts, four bytes a word; only these texts ever travel."""
    # ids grow with the corpus: the same shuffled join at every size, never a broadcast
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(ids.hint("merge"), "doc_id", "left_semi")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(alnum_mask())
        for b in batches:
            words, _, _, first = split(*arrow_bytes(b["text"]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([(words[first[i] : first[i + 1]] >> np.uint64(32)).astype(np.uint32).tobytes() for i in range(b.num_rows)], pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _labels(words: bytes, k: int) -> np.ndarray:
    return labelled(kmers(np.frombuffer(words, np.uint32).astype(np.uint64), k))


def _verified(pairs: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """pairs (a, b) and whether they are similar."""
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("words").alias("wb")), "b").join(texts.select(F.col("doc_id").alias("a"), F.col("words").alias("wa")), "a")
    id_type = pairs.schema["a"].dataType
    out = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type), T.StructField("similar", T.BooleanType())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None
        for b in batches:
            said = []
            for x, y in zip(b["wa"].to_pylist(), b["wb"].to_pylist()):
                if x != last:
                    last, of_last = x, _labels(x, k)
                said.append(alignment(of_last, _labels(y, k), similarity) >= similarity)
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(said, pa.bool_())], names=out.names)

    return both.select("a", "b", "wa", "wb").mapInArrow(verify, out)


def _able(first: DataFrame, members: DataFrame, similarity: float, ordered: bool) -> DataFrame:
    """Pairs (a, b) of leaders (bucket, p, of, p_size, p_at) and other texts of their buckets that may be similar.

    What follows place at of size k-mers bounds how many two texts can share. ordered: leaders meet texts of their length
    or more only.
    """
    need = similarity / (1 + similarity)
    able = F.least(F.col("p_size") - F.col("p_at"), F.col("size") - F.col("at")) >= need * (F.col("p_size") + F.col("size")) - 1e-9
    star = first.join(members, "bucket").filter((F.col("of") != F.col("class")) & able)
    star = star.filter("size >= p_size") if ordered else star
    return star.select(F.least("p", "doc_id").alias("a"), F.greatest("p", "doc_id").alias("b")).distinct()


def _leaders(members: DataFrame, slots: int) -> DataFrame:
    """Up to so many leaders of each bucket: of those who may lead and fall into a slot, that of the greatest score."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots)).alias("slot")
    best = F.min(F.struct((-F.col("score")).alias("score"), "doc_id", "class", "size", "at")).alias("p")
    return members.filter("lead").groupBy("bucket", slot).agg(best).select("bucket", F.col("p.doc_id").alias("p"), F.col("p.class").alias("of"), F.col("p.size").alias("p_size"), F.col("p.at").alias("p_at"))


def _classed(rows: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """rows with their class after links; classes: (doc_id, class) so far, of all that the links name."""
    of = lambda end: classes.select(F.col("doc_id").alias(end), F.col("class").alias(f"class_{end}"))
    joined = links.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    roots = components(joined, "class_a", "class_b", label="so-far").select(F.col("node").alias("class"), F.col("root").alias("__root"))
    return rows.join(roots.hint("merge"), "class", "left").withColumn("class", F.coalesce("__root", "class")).select(rows.columns)


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets of more than one class of which some may lead."""
    mixed = members.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.max("lead").alias("l")).filter("x != y and l").select("bucket")
    return members.join(mixed.hint("merge"), "bucket").select(members.columns)


def _rare(texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """(bucket, doc_id, score, size, at, lead): the rarest labelled k-mers of each text, of which similar texts share one.

    A text of n k-mers shares similarity * n at least with a similar one, so one of its n - similarity * n + 1 first in
    any order that holds for all texts; and 2 * similarity / (1 + similarity) * n with one that is as long or longer, so
    that it needs to lead by as many fewer of its first. The order is that of counts, which are kept by 20 bits of a k-mer:
    what a collision makes look frequent only stands later. K-mers that no other text can have take a place but make no row.
    """
    spark = texts.sparkSession
    slots = np.uint64((1 << 20) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_ = [_labels(w, k) & slots for w in b["words"].to_pylist()]
            slot, n = np.unique(np.concatenate(all_ or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n.astype(np.int64))], names=["slot", "n"])

    counted = texts.select("words").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()
    often = np.ones(1 << 20, np.int64)
    often[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    shared = spark.sparkContext.broadcast(often)
    schema = T.StructType([texts.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("size", T.IntegerType()), T.StructField("skipped", T.IntegerType()), T.StructField("rare", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, size, skipped, rare = [], [], [], []
            for w in b["words"].to_pylist():
                labels = _labels(w, k)
                n = shared.value[(labels & slots).astype(np.int64)]
                first = np.lexsort((labels, n))[: len(n) - int(np.ceil(similarity * len(n) - 1e-9)) + 1]
                alone = int((n[first] == 1).sum())
                score.append(float(np.log2(n).mean()))
                size.append(len(n))
                skipped.append(alone)
                rare.append(labels[first[alone:]].astype(np.int64))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(score, pa.float64()), pa.array(size, pa.int32()), pa.array(skipped, pa.int32()), pa.array(rare, pa.list_(pa.int64()))], names=schema.names)

    rows = texts.select("doc_id", "words").mapInArrow(run, schema).select("doc_id", "score", "size", "skipped", F.posexplode("rare").alias("place", "bucket"))
    leads = F.col("size") - F.ceil(F.col("size") * (2 * similarity / (1 + similarity)) - 1e-9) + 1
    return rows.select("bucket", "doc_id", "score", "size", (F.col("skipped") + F.col("place")).alias("at")).withColumn("lead", F.col("at") < leads)


def links(nodes: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8, entries: int = 12, ell: int = 3, at_once: int = 4096) -> DataFrame:
    """(a, b) verified links between nodes (doc_id, sketch, size), one per text: enough of them to connect each class.

    Once no bucket has more than at_once texts that have still to lead, all of them do, in one round.
    """
    buckets = nodes.select("doc_id", "size", F.explode("sketch").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = buckets.join(shared.hint("merge"), "bucket").select("bucket", "doc_id", F.col("doc_id").alias("class"), F.lit(0.0).alias("score"), "size", F.lit(0).alias("at"), F.lit(True).alias("lead"))
    members = written(members, "members")
    texts = written(_word_table(docs, members.select("doc_id").distinct(), id_col, text_col).dropDuplicates(["doc_id"]), "words")

    def similar(pairs: DataFrame) -> DataFrame:
        return written(_verified(pairs, texts, k, similarity).filter("similar").select("a", "b"), "links")

    known = similar(_able(_leaders(members, 1), members, similarity, False))
    # a node's class is itself until it is linked
    own = members.select("doc_id", "class").distinct()
    left = written(_mixed(_classed(members, known, own)).groupBy("doc_id").agg(F.min("class").alias("class")), "left")
    drop(members)
    if left.isEmpty():
        return known
    rare = _rare(texts.join(left.hint("merge"), "doc_id", "left_semi"), k, similarity).join(left.hint("merge"), "doc_id")
    open_, slots = written(_mixed(rare.select("bucket", "doc_id", "class", "score", "size", "at", "lead")), "rare"), 4
    while not open_.isEmpty():
        most = open_.groupBy("bucket").agg(F.count_if("lead").alias("n")).agg(F.max("n")).first()[0]
        if slots > 4 and most <= at_once:
            every = open_.filter("lead").select("bucket", F.col("doc_id").alias("p"), F.col("class").alias("of"), F.col("size").alias("p_size"), F.col("at").alias("p_at"))
            return known.union(similar(_able(every, open_, similarity, True)))
        first = _leaders(open_, slots)
        found = similar(_able(first, open_, similarity, True))
        led = first.select("bucket", F.col("p").alias("doc_id"), F.lit(True).alias("__led"))
        after = open_.join(led.hint("merge"), ["bucket", "doc_id"], "left").withColumn("lead", F.col("lead") & F.col("__led").isNull()).select(open_.columns)
        if not found.isEmpty():
            known = known.union(found)
            after = _classed(after, found, open_.select("doc_id", "class").distinct())
        before, open_ = open_, written(_mixed(after), "open")
        drop(before)
        slots *= 16
    return known


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8, entries: int = 12, ell: int = 3) -> DataFrame:
    """(doc_id, class_id), a row per row of docs; class_id is the least id of its class."""
    spark = docs.sparkSession
    small_batches(spark)
    sketched = written(_sketches(docs, id_col, text_col, k, entries, ell), "sketches")
    firsts = sketched.groupBy("key").agg(F.min("doc_id").alias("first"))
    member = written(sketched.select("doc_id", "key").join(firsts, "key").select("doc_id", "first").distinct(), "first")
    nodes = sketched.join(firsts.select(F.col("first").alias("doc_id")).hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    found = links(nodes.select("doc_id", "sketch", "size"), docs, id_col=id_col, text_col=text_col, k=k, similarity=similarity, entries=entries, ell=ell)
    # an id that repeats with other texts belongs with all of them
    same = member.groupBy("doc_id").agg(F.min("first").alias("u"), F.max("first").alias("v")).filter("u != v").select("u", "v")
    roots = components(found.select(F.col("a").alias("u"), F.col("b").alias("v")).union(same), label="classes")
    of = member.groupBy("doc_id").agg(F.min("first").alias("first"))
    of = of.join(roots.withColumnRenamed("node", "first"), "first", "left").select("doc_id", F.coalesce("root", "first").alias("class_id"))
    rows = docs.select(F.col(id_col).alias("doc_id"))
    return rows.join(of, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
