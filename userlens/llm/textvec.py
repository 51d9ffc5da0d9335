"""Whole Arrow text columns as numpy arrays: words, word hashes, runs per document.

A batch of texts is one UTF-8 buffer with offsets, so word bounds, word hashes and
n-gram hashes of all its documents come from a few numpy passes, without a Python
object per word. A word is a run of bytes other than 0x20 and 0x09-0x0D; UTF-8
continuation bytes are never in that range, so this equals the same rule on characters.
Buffers are handled in slices of at most ``SLICE_BYTES`` cut between documents (a longer
document is a slice of its own), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Bytes hashed at once; bounds the 8-byte-per-byte temporaries for a very long text.
HASH_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_POW = _powers(HASH_BYTES, int(_BASE))
_INV = _powers(HASH_BYTES, pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer document is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are disjoint and ascending."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = int(np.searchsorted(end, base + HASH_BYTES, side="right"))
        if stop <= at:  # one span longer than a block
            out[at] = _long_hash(raw[base:int(end[at])])
            at += 1
            continue
        last = int(end[stop - 1])
        acc = np.empty(last - base + 1, dtype=np.uint64)
        acc[0] = 0
        np.cumsum((raw[base:last].astype(np.uint64) + np.uint64(1)) * _POW[:last - base], out=acc[1:])
        s, e = start[at:stop] - base, end[at:stop] - base
        out[at:stop] = (acc[e] - acc[s]) * _INV[s % HASH_BYTES]
        at = stop
    return mix(out + (end - start).astype(np.uint64) * _M2)


def _long_hash(part: np.ndarray) -> np.uint64:
    total = 0
    for k in range(0, len(part), HASH_BYTES):
        piece = part[k:k + HASH_BYTES]
        block = int(((piece.astype(np.uint64) + np.uint64(1)) * _POW[:len(piece)]).sum(dtype=np.uint64))
        total = (total + block * pow(int(_BASE), k, 1 << 64)) & (2 ** 64 - 1)
    return np.uint64(total)


@dataclass
class Words:
    """Words of a run of documents, in order. ``doc`` is the row of each word."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.raw, self.start, self.end)


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    n = len(offsets) - 1
    if lower:
        raw = _LOWER[raw]
    solid = np.zeros(len(raw) + 2, dtype=bool)
    solid[1:-1] = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True  # a text's end parts words, too
    begin = solid[1:] & (~solid[:-1] | edge)
    finish = solid[:-1] & (~solid[1:] | edge)
    start, end = np.flatnonzero(begin), np.flatnonzero(finish)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(raw, offsets, start, end, doc, np.bincount(doc, minlength=n).astype(np.int64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (runs may cross documents)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * _BASE + words[k:len(words) - n + 1 + k]
    return mix(out)


def whole_grams(doc: np.ndarray, n: int) -> np.ndarray:
    """True where a run of n words stays inside one document."""
    if len(doc) < n:
        return np.zeros(0, dtype=bool)
    return doc[n - 1:] == doc[:len(doc) - n + 1]


def starts_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def distinct_sets(doc: np.ndarray, grams: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each document, laid end to end, with their bounds."""
    order = np.lexsort((grams, doc))
    d, g = doc[order], grams[order]
    keep = np.ones(len(g), dtype=bool)
    if len(g):
        keep[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    d, g = d[keep], g[keep]
    return g, starts_of(np.bincount(d, minlength=n_docs).astype(np.int64))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int, lower: bool = True
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text (a shorter text's whole word sequence is one
    shingle, no words give none): hashes laid end to end and sorted per document, their
    bounds, and the words per document."""
    w = words_of(raw, offsets, lower)
    h = w.hashes()
    inside = whole_grams(w.doc, n)
    grams, doc = gram_hashes(h, n)[inside], w.doc[:len(inside)][inside]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        at = starts_of(w.counts)
        extra = np.empty(len(short), dtype=np.uint64)
        for k, d in enumerate(short):
            extra[k] = gram_hashes(h[at[d]:at[d + 1]], int(w.counts[d]))[0] + np.uint64(w.counts[d])
        grams, doc = np.concatenate([grams, mix(extra)]), np.concatenate([doc, short])
    sets, bounds = distinct_sets(doc, grams, len(offsets) - 1)
    return sets, bounds, w.counts
