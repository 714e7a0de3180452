"""Benchmark decontamination by an FM-index per training shard.

Texts stream into shards of about shard_words words. A shard's words become integers, and an FM-index of them is made:
suffix order by prefix doubling, the Burrows-Wheeler transform in a wavelet tree, and every eighth text position
sampled. All test phrases (windows of words) are searched backwards at once through wavelet-tree ranks; occurrences
are located by walking to sampled positions, and their spans are merged per text.

Words that no test phrase holds can't lie in an occurrence. So the index holds a shard's runs of phrase words that are
at least as long as the shortest phrase, in full, each closed by an end symbol; the other words are only counted. This
leaves every occurrence in, whatever the data.

Test phrases come in blocks of about block_bytes of text, one at a time: a block is read, broadcast and searched over
all texts by a pass of its own, which adds to the spans so far and is written before the next block is read and the
block is let go. So driver and workers hold one block, however large the test set is. Nothing is shuffled.

Cases: null or empty text: no words, no hits. Items without words never occur; an item of fewer words than the window
is one window. Null item ids: the id "null". Repeated items: their id counts once. Repeated rows: each searched. Empty
tables: no rows, or no hits. Words are compared by 64-bit hashes. Columns of docs pass through; those named like the
result's (n_words, spans, items) are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, small_batches, written
from .tokens import Lookup, Words, alnum_mask, arrow_bytes

SAMPLE = 8


class WaveletTree:
    """Symbols by bits, the highest first: a row of bits and its running sums per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.zeros(len(now) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(now) - int(ones[-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol occurs before position at, elementwise."""
        first, at = np.zeros_like(at), at.copy()
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            a, f = ones[at], ones[first]
            at = np.where(bit, zeros + a, at - a)
            first = np.where(bit, zeros + f, first - f)
        return at - first


class FmIndex:
    """Over integers 1..sigma; 0 ends a run. No search goes beyond a run's end or begin."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(text)
        ends = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))  # each end differs, so that no comparison goes beyond it
        step, order = 1, np.argsort(rank)
        sorted_ = rank[order]
        rank[order] = np.cumsum(np.concatenate([[0], (sorted_[1:] != sorted_[:-1]).astype(np.int64)])) if n else rank
        while n and rank[order[-1]] < n - 1:
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = rank[step:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key)
            sorted_ = key[order]
            rank[order] = np.cumsum(np.concatenate([[0], (sorted_[1:] != sorted_[:-1]).astype(np.int64)]))
            step *= 2
        last = np.where(order > 0, text[order - 1], 0) if n else text
        self.n, self.last = n, last
        self.tree = WaveletTree(last, max(1, int(sigma).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        kept = (order % sample == 0) | (last == 0)  # a run's begin is sampled: no walk leaves a run
        self.sampled, self.before, self.place = kept, np.cumsum(kept) - kept, order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges lo, hi of phrases, one per row, all of the same length."""
        lo = self.first[phrases[:, -1]]
        hi = self.first[phrases[:, -1] + 1]
        live = np.flatnonzero(lo < hi)
        for j in range(phrases.shape[1] - 2, -1, -1):
            c = phrases[live, j]
            lo[live] = self.first[c] + self.tree.rank(c, lo[live])
            hi[live] = self.first[c] + self.tree.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(lo, hi)
        dead = np.ones(len(lo), bool)
        dead[live] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks."""
        out, steps, rows = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        live = np.arange(len(rows))
        while len(live):
            at = rows[live]
            done = self.sampled[at]
            out[live[done]] = self.place[self.before[at[done]]] + steps[live[done]]
            live, at = live[~done], at[~done]
            c = self.last[at]
            rows[live] = self.first[c] + self.tree.rank(c, at)
            steps[live] += 1
        return out


class Phrases:
    """The windows of a block of items, as integers over their own words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        split = Words(alnum_mask())
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            words = split.of(text or "").tolist()
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[at : at + window]), set()).add(number[item])
        self.vocabulary = np.array(sorted({w for p in owners for w in p}), np.uint64)
        self.shortest = min(map(len, owners), default=0)
        self.by_length = []
        for size in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == size]
            symbols = np.searchsorted(self.vocabulary, np.array(own, np.uint64)).astype(np.int64) + 1
            counts = np.array([len(owners[p]) for p in own])
            self.by_length.append((size, symbols, np.concatenate([[0], np.cumsum(counts)]), np.array([i for p in own for i in sorted(owners[p])], np.int64)))
        self.lookup = Lookup(self.vocabulary)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and length of each occurrence, and its item's number (an occurrence of two items comes twice)."""
        symbols = self.lookup(words)
        edge = np.diff(np.concatenate([[0], (symbols > 0).astype(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - begin >= max(1, self.shortest)
        begin, end = begin[long], end[long]
        none = np.zeros(0, np.int64)
        if not len(begin) or not self.by_length:
            return none, none, none
        sizes = end - begin + 1
        to = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(to - begin, sizes)
        text = np.concatenate([symbols, [0]])[place].astype(np.int64)
        text[to + sizes - 1] = 0
        index = FmIndex(text, len(self.vocabulary))
        out = []
        for size, symbols_, starts, items in self.by_length:
            lo, hi = index.search(symbols_)
            n = hi - lo
            which = np.repeat(np.arange(len(n)), n)
            rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            at = place[index.locate(rows)]
            m = starts[which + 1] - starts[which]
            item = items[np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(starts[which], m)]
            out.append((np.repeat(at, m), np.full(len(item), size), item))
        return tuple(np.concatenate(x) for x in zip(*out))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


_SPANS = "array<struct<word_begin:int,word_end:int,byte_begin:int,byte_end:int>>"


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    block, size = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    for r in rows.toLocalIterator():
        block.append((r["i"], r["t"]))
        size += len(r["t"]) * 2 + 64
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def scan(docs: DataFrame, items: DataFrame, *, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", cut: bool = False, shard_words: int = 1 << 20, block_bytes: int = 4 << 20) -> DataFrame:
    """docs and n_words int, spans (merged; words and bytes, ends excluded), items array<string>, sorted.

    cut: instead, docs with the spans taken out of the text (and n_chars, if there is such a column, counted anew); a
    text of which no word is left goes.
    """
    spark = docs.sparkSession
    small_batches(spark, 2000)
    docs = docs.drop(*[c for c in ("n_words", "spans", "items") if c in docs.columns])
    held = [f for f in docs.schema.fields]
    state = [T.StructField("n_words", T.IntegerType()), T.StructField("spans", T._parse_datatype_string(_SPANS)), T.StructField("items", T.ArrayType(T.StringType()))]
    out_schema = T.StructType([*held, *state])
    df = docs.withColumns({"n_words": F.lit(0).cast("int"), "spans": F.array().cast(_SPANS), "items": F.array().cast("array<string>")})

    def passes(phrases):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, p = Words(alnum_mask()), phrases.value
            held_, words = [], 0
            for b in batches:
                data, offsets = arrow_bytes(b[text_col])
                parts = split(data, offsets)
                held_.append((b, parts))
                words += len(parts[0])
                if words >= shard_words:
                    yield from _shard(held_, p, window, text_col)
                    held_, words = [], 0
            yield from _shard(held_, p, window, text_col)

        return run

    done = None
    blocks = _blocks(items, item_id, item_text, block_bytes)
    now = next(blocks, [])
    while now is not None:
        phrases = spark.sparkContext.broadcast(Phrases(now, window))
        df, now = df.mapInArrow(passes(phrases), out_schema), next(blocks, None)
        if now is not None:
            df = written(df, "searched")
            drop(done)
            phrases.destroy()
            done = df
    if not cut:
        return df

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b[text_col]
            hit = [i for i, s in enumerate(b["spans"]) if len(s)]
            values = texts.to_pylist() if hit else None
            for i in hit:
                raw, at, left = values[i].encode(), 0, []
                for s in b["spans"][i].as_py():
                    left.append(raw[at : s["byte_begin"]])
                    at = s["byte_end"]
                values[i] = b"".join([*left, raw[at:]]).decode()
            keep = np.ones(b.num_rows, bool)
            for i in hit:
                spans = b["spans"][i].as_py()
                keep[i] = sum(s["word_end"] - s["word_begin"] for s in spans) < b["n_words"][i].as_py()
            columns = {f.name: b[f.name] for f in held}
            if hit:
                columns[text_col] = pa.array(values, texts.type)
                if "n_chars" in columns:
                    counts = b["n_chars"].to_pylist()
                    for i in hit:
                        counts[i] = len(values[i])
                    columns["n_chars"] = pa.array(counts, b["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(keep))

    return df.mapInArrow(cuts, T.StructType(held))


def _shard(held: list, phrases: Phrases, window: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """The batches of a shard with what its index finds added to their spans and items."""
    if not held:
        return
    # an end symbol between texts: no phrase word has hash 0 in any vocabulary slot that counts
    counts = [np.diff(parts[3]) for _, parts in held]
    per_doc = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(per_doc + 1)])
    words = np.zeros(int(starts[-1]), np.uint64)
    at = np.arange(int(per_doc.sum())) + np.repeat(np.arange(len(per_doc)), per_doc)
    words[at] = np.concatenate([parts[0] for _, parts in held]) if held else words[at]
    first, size, item = phrases.find(words)
    doc = np.searchsorted(starts, first, "right") - 1
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size, -1)
    hit = np.cumsum(edge[:-1]) > 0
    turn = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    owner = np.searchsorted(starts, begin, "right") - 1
    found: dict[int, tuple[list, set]] = {}
    for d, b, e in zip(owner.tolist(), begin.tolist(), end.tolist()):
        found.setdefault(d, ([], set()))[0].append((b - int(starts[d]), e - int(starts[d])))
    pairs = np.unique(doc * (len(phrases.ids) + 1) + item) if len(doc) else doc
    for x in pairs.tolist():
        found[x // (len(phrases.ids) + 1)][1].add(phrases.ids[x % (len(phrases.ids) + 1)])
    base = 0
    for (batch, (_, s, e, f)), n in zip(held, counts):
        spans, items = batch["spans"].to_pylist(), batch["items"].to_pylist()
        for i in range(batch.num_rows):
            if base + i in found:
                new, ids = found[base + i]
                old = [(x["word_begin"], x["word_end"]) for x in spans[i]]
                merged = _merged([*old, *new])
                spans[i] = [{"word_begin": b, "word_end": x, "byte_begin": int(s[f[i] + b] - _doc_begin(batch, text_col, i)), "byte_end": int(e[f[i] + x - 1] - _doc_begin(batch, text_col, i))} for b, x in merged]
                items[i] = sorted({*items[i], *ids})
        base += batch.num_rows
        schema = batch.schema
        done = {"n_words": pa.array(n.astype(np.int32)), "spans": pa.array(spans, schema.field("spans").type), "items": pa.array(items, schema.field("items").type)}
        yield pa.RecordBatch.from_arrays([done.get(name, batch[name]) for name in schema.names], names=schema.names)


def _doc_begin(batch: pa.RecordBatch, text_col: str, row: int) -> int:
    """The first byte of a row's text among the batch's bytes."""
    col = batch[text_col]
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    at = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + row + 1]
    return int(at[-1]) - int(at[0])


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs' columns but the text, and n_words, n_hit, n_items (long), items_sha256, contaminated."""
    text = options.get("text_col", "text")
    found = scan(docs, items, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["word_end"] - s["word_begin"]))
    out = found.select(*[c for c in docs.columns if c not in (text, "n_words", "spans", "items")], F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def digest(items: list[str]) -> str:
    """items_sha256 of a list of ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
