"""Vectorised words: an Arrow text column becomes 64-bit word hashes and positions, without a Python object per word.

A word's hash is a polynomial over randomly weighted bytes modulo 2**64, taken from running sums; equal words get
equal hashes in every process, and different ones collide with a probability of about n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_R = 0x9E3779B97F4A7C15  # odd, 5 modulo 8: of full order
_M = (1 << 64) - 1
_RINV = pow(_R, -1, 1 << 64)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _M, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_R, BLOCK), _powers(_RINV, BLOCK)


def space_mask() -> np.ndarray:
    """Word bytes of [^\\x20\\x09-\\x0D]."""
    m = np.ones(256, bool)
    m[[0x20, *range(0x09, 0x0E)]] = False
    return m


def alnum_mask() -> np.ndarray:
    """Word bytes of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z."""
    m = np.zeros(256, bool)
    m[0x30:0x3A] = m[0x41:0x5B] = m[0x61:0x7B] = m[0x80:] = True
    return m


def arrow_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Words:
    """Splits bytes into words. mask: the bytes that words consist of; A-Z counts as a-z."""

    def __init__(self, mask: np.ndarray):
        self.mask = mask
        weights = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
        weights[0x41:0x5B] = weights[0x61:0x7B]
        self.weights = weights

    def _cut(self, data: np.ndarray, offsets: np.ndarray, begin: int) -> int:
        """Where a piece from begin can end: about BLOCK bytes on, not inside a word."""
        step = BLOCK
        while True:
            end = begin + step
            if end >= len(data):
                return len(data)
            gaps = np.flatnonzero(~self.mask[data[begin:end]])
            doc = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            cut = max(begin + int(gaps[-1]) + 1 if len(gaps) else begin, doc)
            if cut > begin:
                return cut
            step *= 2

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end byte of each word, and each text's first word (with the total at the end)."""
        hashes, starts, ends = [], [], []
        at = 0
        while at < len(data):
            end = self._cut(data, offsets, at)
            part = data[at:end]
            m = self.mask[part]
            before, after = np.zeros(len(m), bool), np.zeros(len(m), bool)
            before[1:], after[:-1] = m[:-1], m[1:]
            docs = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
            before[docs] = False
            after[docs[docs > 0] - 1] = False
            s, e = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
            n = len(part)
            power, inverse = (_POW, _INV) if n <= BLOCK else (_powers(_R, n), _powers(_RINV, n))
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.weights[part] * power[:n], out=total[1:])
            hashes.append(mix((total[e] - total[s]) * inverse[s]))
            starts.append(s + at)
            ends.append(e + at)
            at = end
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        s = join(starts, np.int64)
        return join(hashes, np.uint64), s, join(ends, np.int64), np.searchsorted(s, offsets)

    def of(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self(raw, np.array([0, len(raw)]))[0]


class Lookup:
    """1 + the place of each hash in a sorted vocabulary, 0 for others, by plain reads of tables over leading bits."""

    def __init__(self, vocabulary: np.ndarray, bits: int = 20):
        self.vocabulary, self.shift, self.slots = vocabulary, np.uint64(64 - bits), []
        free = np.arange(len(vocabulary))
        while len(free):
            slot = np.full(1 << bits, -1, np.int32)
            at = (vocabulary[free] >> self.shift).astype(np.int64)
            slot[at[::-1]] = free[::-1]
            self.slots.append(slot)
            free = free[slot[at] != free]

    def __call__(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int32)
        at = (words >> self.shift).astype(np.int64)
        for slot in self.slots:
            k = slot[at]
            found = np.flatnonzero(k >= 0)
            found = found[self.vocabulary[k[found]] == words[found]]
            out[found] = k[found] + 1
        return out
