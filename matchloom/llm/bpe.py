"""Byte-level BPE encoding and decoding with overlapping chunks.

A text longer than chunk characters is cut into chunks that overlap. Each is pre-tokenised by itself, in parallel tasks.
The pattern looks ahead but never back, so once two neighbouring chunks both begin a pre-token at the same place in
their overlap, all that follows is the same: the texts are stitched there. A boundary counts only where the token
before it ends in no white space and the chunk goes on for a while, so that no look-ahead saw the chunk's end. Only
the boundaries meet, a few numbers per chunk; then each chunk's piece, from its stitch to the next, is encoded by a task
of its own, so that one text with a third of all characters is encoded by many tasks. Where an overlap has no common
boundary (a run longer than the overlap), the rest of that text is read on by one task, until boundaries meet again. Ids
are concatenated in order, and decoding concatenates the ids' raw bytes.

Cases: null text: empty, no ids. Null ids: kept; ids of any type. Repeated rows: each encoded. Very long texts: chunk by
chunk, and the digests of a text stream over its sorted pieces. Empty table: no rows. Other columns stay out of the result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, small_batches, written

#: Characters of a chunk, and of what it shares with the next.
CHUNK, OVERLAP = 1 << 14, 1 << 10
_coders: dict[tuple[str, str], Coder] = {}


class Coder:
    """Ranks from a file of base64 tokens and numbers; pattern splits texts into pre-tokens."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            self.bytes[rank] = token

    def encode_piece(self, piece: str) -> list[int]:
        return self.coding.encode_ordinary(piece)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def boundaries(self, text: str, lo: int, hi: int) -> list[int]:
        """Where pre-tokens of text begin within lo..hi, as far as no end of text had a say and no space comes before."""
        return [m.start() for m in self.pattern.finditer(text) if lo <= m.start() < hi and m.start() and not text[m.start() - 1].isspace()]


def coder(ranks: str | None = None, pattern: str | None = None) -> Coder:
    key = (ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    if key not in _coders:
        _coders[key] = Coder(*key)
    return _coders[key]


def encode(docs: DataFrame, *, ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, part int, parts int, ids array<int>): a text of up to chunk characters is one part; a longer one's chunks are
    pre-tokenised and encoded in tasks of their own and come as several parts, in order within a partition."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = rows.schema["doc_id"]
    int_, ints = T.IntegerType(), T.ArrayType(T.IntegerType())
    fields = lambda *named: T.StructType([own, *[T.StructField(n, t) for n, t in named]])
    encoded = fields(("part", int_), ("parts", int_), ("ids", ints))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = [np.array(c.encode_piece(t), np.int32) for t in part["text"].to_pylist()]
                n = len(ids)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()), _lists(ids)], names=encoded.names)

    # chunks of long texts, with the overlap behind their own characters, and where pre-tokens begin in their overlaps
    chunked = fields(("key", T.StringType()), ("part", int_), ("parts", int_), ("chunk", T.StringType()))
    seen = fields(("key", T.StringType()), ("part", int_), ("parts", int_), ("chunk", T.StringType()), ("first", ints), ("last", ints))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text, key = b["text"][i].as_py(), uuid.uuid4().hex  # written once, so a key is read as it was made
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(n):
                    end = (k + 1) * chunk + overlap if k < n - 1 else len(text)
                    yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, 1), pa.array([key]), pa.array([k], pa.int32()), pa.array([n], pa.int32()), pa.array([text[k * chunk : end]])], names=chunked.names)

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """As offsets in the text: boundaries in the overlap with the chunk before and with the chunk after."""
        c = coder(ranks, pattern)
        for b in batches:
            texts, at = b["chunk"].to_pylist(), [k * chunk for k in b["part"].to_pylist()]
            first = [np.array(c.boundaries(x[:overlap], 1, overlap // 2), np.int32) + k for x, k in zip(texts, at)]
            last = [np.array(c.boundaries(x, len(x) - overlap, len(x) - overlap // 2), np.int32) + k for x, k in zip(texts, at)]
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(first), _lists(last)], names=seen.names)

    group = fields(("key", T.StringType()), ("part", int_), ("parts", int_), ("ids", ints))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encodes each chunk from its begin to its end; in a run of chunks, up to the last boundary shared with the next one."""
        c = coder(ranks, pattern)
        carried, base = "", 0
        for b in batches:
            for i, (text, part, parts, begins, ends, next_first) in enumerate(zip(*(b[n].to_pylist() for n in ("chunk", "part", "parts", "begins", "ends", "next_first")))):
                if begins is not None:
                    carried, base = text[begins - part * chunk :], begins
                else:
                    carried += text[overlap:]
                cut = base + len(carried) if part == parts - 1 else ends
                if cut is None:
                    n = len(carried)
                    cut = min({x + base for x in c.boundaries(carried, n - overlap, n - overlap // 2)} & set(next_first), default=base)
                piece, carried, base = carried[: cut - base], carried[cut - base :], cut
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, 1), b["key"].slice(i, 1), b["part"].slice(i, 1), b["parts"].slice(i, 1), _lists([np.array(c.encode_piece(piece), np.int32)])], names=group.names)

    short = rows.filter(F.length("text") <= chunk).mapInArrow(whole, encoded)
    plain = written(rows.filter(F.length("text") > chunk).mapInArrow(chunks, chunked), "chunks")
    cut = written(plain.repartition("key", "part").mapInArrow(boundaries, seen), "boundaries")
    drop(plain)  # the boundaries' table holds the chunks too
    # A few numbers per chunk meet in a window by text. What follows the first overlap without a common boundary is one
    # run: those chunks' own boundaries are known to be right only once that run has been read.
    w, whole_text = Window.partitionBy("key").orderBy("part"), Window.partitionBy("key")
    edges = cut.select("key", "part", "parts", "first", "last").withColumn("next_first", F.lead("first").over(w))
    edges = edges.withColumn("meets", F.array_min(F.array_intersect("last", "next_first")))
    edges = edges.withColumn("broken", F.coalesce(F.min(F.when(F.col("meets").isNull(), F.col("part"))).over(whole_text), F.col("parts")))
    edges = edges.withColumns({"ends": F.when(F.col("part") < F.col("broken"), F.col("meets")), "run": F.least("part", "broken")})
    begins = F.when(F.col("part") == 0, 0).when(F.col("part") <= F.col("broken"), F.lag("meets").over(w))
    edges = edges.select("key", "part", "run", "ends", begins.alias("begins"), F.when(F.col("part") >= F.col("broken"), F.coalesce("next_first", F.array().cast("array<int>"))).alias("next_first"))
    runs = cut.drop("first", "last").join(edges, ["key", "part"])
    runs = runs.select("doc_id", "key", "part", "parts", "chunk", "begins", "ends", "next_first", "run").repartition("key", "run").sortWithinPartitions("key", "run", "part")
    long = runs.mapInArrow(pieces, group)
    long = long.repartition("key").sortWithinPartitions("key", "part").drop("key")
    return short.union(long)


def _lists(of: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(of) + 1, np.int32)
    np.cumsum([len(x) for x in of], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(of) if of else np.zeros(0, np.int32), pa.int32()))


def digests(encoded: DataFrame, *, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 from encode()'s parts, which are still in order."""
    schema = T.StructType([encoded.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks, pattern)
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for b in batches:
            done, out = [], []
            lists = b["ids"]
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, (part, parts) in enumerate(zip(b["part"].to_pylist(), b["parts"].to_pylist())):
                if part == 0:
                    n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                ids = flat[offsets[i] : offsets[i + 1]]
                n += len(ids)
                of_ids.update(ids.astype("<u4").tobytes())
                of_bytes.update(c.decode(ids.tolist()))
                if part == parts - 1:
                    done.append(i)
                    out.append((n, of_ids.hexdigest(), of_bytes.hexdigest()))
            n_, a, d = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(pa.array(done, pa.int64())), pa.array(n_, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
