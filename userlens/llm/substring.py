"""Passages that repeat across documents: MinHash banding over paragraphs.

Paragraphs are the lines of a text of at least ``LINE_WORDS`` words and, so that a passage is found
wherever it stands and however it is wrapped, the text's pieces: the words of the whole text, whatever
their lines, are cut before a word whose 3-word hash is the smallest among its neighbours within
``REACH`` words, which depends on the words alone, so two texts that share a passage are cut alike
inside it.

1. One pass writes each paragraph with its place and a digest of its words (lower-cased). Equal
   paragraphs are one node from here on; their copies are only ever counted, by partial sums.
2. Lines get MinHash signatures over their sets of 5-word shingles. ``bands`` picks bands and rows
   so that a pair at the threshold collides with at least the wished probability. A task emits
   the bands of a line once. Lines that collide are tied to the smallest one at the band.
3. Tied lines form families, in whose cells the exact Jaccard similarity decides (0.8 or more);
   links become components. Pieces are compared by their words: equal or not.
4. A class found in two documents or more repeats. Its places count where they cover, with those
   that touch or overlap them, ``PASSAGE_WORDS`` words on end. The first place of a class
   (smallest doc_id, then place) stays, the others are to be removed.

Defined results: a null or empty text and one of less than ``PIECE_WORDS`` words have no paragraphs; a row
without doc_id takes no part; repeated rows of one id are one document, so they repeat nothing
across documents; an empty table gives an empty table; other columns, whatever their names, are
not looked at (``remove_passages`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .jaccard import CELL, link_families
from .shared import written

SHINGLE = 5
PERCENT = 80
RECALL = 0.995
LINE_WORDS = 10
PIECE_WORDS = 6
REACH = 5
#: Repeats must cover so many words on end; single short lines that many documents have are no passages.
PASSAGE_WORDS = 16
MOST_BANDS = 8


def bands(percent: int = PERCENT, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest chance collisions, with which ``most`` bands
    let a pair at the threshold collide with probability ``recall``; then the fewest bands."""
    for rows in range(8, 0, -1):
        for n in range(1, most + 1):
            if 1 - (1 - (percent / 100) ** rows) ** n >= recall:
                return n, rows
    raise ValueError("no banding reaches the recall")


def _run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each disjoint ascending run of values."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, base + tv.HASH_BYTES, side="right")))
        last = int(end[stop - 1])
        if last - base > tv.HASH_BYTES:  # one run longer than the table of powers
            out[at] = tv.mix(np.add.reduce(tv.mix(values[base:last] + np.arange(last - base, dtype=np.uint64)), keepdims=True))[0]
            at += 1
            continue
        acc = np.zeros(last - base + 1, dtype=np.uint64)
        np.cumsum(values[base:last] * tv._POW[:last - base], out=acc[1:])
        s, e = start[at:stop] - base, end[at:stop] - base
        out[at:stop] = (acc[e] - acc[s]) * tv._INV[s % tv.HASH_BYTES]
        at = stop
    return tv.mix(out + (end - start).astype(np.uint64) * tv._M2)


class Paragraphs:
    """Lines and pieces of a run of texts as runs of words [start, end). Pieces may cross lines."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        w = self.words = tv.words_of(raw, offsets, lower=True)
        self.hashes = w.hashes()
        n = len(w.start)
        newlines = np.cumsum(raw == 10)
        line = newlines[w.start] if n else np.zeros(0, np.int64)
        new = np.ones(n, dtype=bool)
        if n:
            new[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
        self.first_word = tv.starts_of(w.counts)
        start = np.flatnonzero(new)
        end = np.append(start[1:], n) if len(start) else start
        whole = end - start >= LINE_WORDS
        self.line_start, self.line_end = start[whole], end[whole]
        cut = self._cuts(w.doc)
        cut[self.first_word[:-1][w.counts > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n) if len(start) else start
        # A piece stays where it is a line, too: elsewhere its words may be wrapped in another way.
        part = end - start >= PIECE_WORDS
        self.piece_start, self.piece_end = start[part], end[part]

    def _cuts(self, doc: np.ndarray) -> np.ndarray:
        n = len(doc)
        out = np.zeros(n, dtype=bool)
        if n < 3:
            return out
        top = np.uint64(2 ** 64 - 1)
        g = np.full(n, top)
        g[:n - 2] = np.where(doc[2:] == doc[:-2], tv.gram_hashes(self.hashes, 3), top)
        least = np.ones(n, dtype=bool)
        for k in range(1, REACH + 1):
            same = doc[k:] == doc[:-k]
            least[k:] &= ~same | (g[k:] < g[:-k])
            least[:-k] &= ~same | (g[:-k] < g[k:])
        out[:] = least & (g != top)
        return out

    def shingles(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' 5-word shingles end to end, and their bounds."""
        n = end - start - SHINGLE + 1
        at = np.arange(int(n.sum())) + np.repeat(start - tv.starts_of(n)[:-1], n)
        return self.grams[at], tv.starts_of(n)

    @cached_property
    def grams(self) -> np.ndarray:
        return tv.gram_hashes(self.hashes, SHINGLE)


def signatures(grams: np.ndarray, bounds: np.ndarray, n: int, rows: int) -> np.ndarray:
    """[lines, n] band values: each a hash of ``rows`` minima of the line's shingles."""
    out = np.empty((len(bounds) - 1, n), dtype=np.uint64)
    for b in range(n):
        value = np.full(len(bounds) - 1, b + 1, dtype=np.uint64)
        for r in range(rows):
            salt = tv.mix(np.array([b * rows + r + 1], dtype=np.uint64))[0]
            value = tv.mix(value * tv._M1 + np.minimum.reduceat(tv.mix(grams ^ salt), bounds[:-1]))
        out[:, b] = value
    return out


def paragraphs(docs: DataFrame, banding: tuple[int, int]) -> DataFrame:
    """doc_id, kind (0 line, 1 piece), start, n_words (in words), from_byte, to_byte, digest, sigs of
    every paragraph; ``sigs`` only at a line's first time in the task."""
    names = ["doc_id", "kind", "start", "n_words", "from_byte", "to_byte", "digest", "sigs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                p = Paragraphs(raw[o[0]:o[-1]], o - o[0])
                start, end = np.concatenate([p.line_start, p.piece_start]), np.concatenate([p.line_end, p.piece_end])
                if not len(start):
                    continue
                n_lines = len(p.line_start)
                digest = np.concatenate([_run_hashes(p.hashes, p.line_start, p.line_end), _run_hashes(p.hashes, p.piece_start, p.piece_end)])
                _, first = np.unique(digest[:n_lines], return_index=True)
                first = np.sort(first[~np.isin(digest[first], seen)])
                seen = np.concatenate([seen, digest[first]])
                sigs = signatures(*p.shingles(p.line_start[first], p.line_end[first]), *banding) if len(first) else np.zeros((0, banding[0]), np.uint64)
                count = np.zeros(len(start), dtype=np.int32)
                count[first] = banding[0]
                doc = p.words.doc[start]
                lists = pa.ListArray.from_arrays(pa.array(tv.starts_of(count).astype(np.int32)), pa.array(sigs.ravel().view(np.int64)))
                base = (o - o[0])[doc]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array((np.arange(len(start)) >= n_lines).astype(np.int8)),
                    pa.array((start - p.first_word[doc]).astype(np.int32)), pa.array((end - start).astype(np.int32)),
                    pa.array((p.words.start[start] - base).astype(np.int32)), pa.array((p.words.end[end - 1] - base).astype(np.int32)),
                    pa.array(digest.view(np.int64)), lists], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null").mapInArrow(
        run, "doc_id long, kind byte, start int, n_words int, from_byte int, to_byte int, digest long, sigs array<long>")


def _line_sets(rows: DataFrame) -> DataFrame:
    """(doc_id, family, chunk, chunks, shingles) of the lines that ``wanted`` of a row's text names; doc_id
    is the line's digest."""
    names = ["doc_id", "family", "chunk", "chunks", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column("text"))
            wanted = batch.column("wanted").to_pylist()
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                p = Paragraphs(raw[o[0]:o[-1]], o - o[0])
                digest = _run_hashes(p.hashes, p.line_start, p.line_end).view(np.int64)
                want = {(d - a, x["node"]): x for d in range(a, b) for x in wanted[d]}
                doc = p.words.doc[p.line_start]
                spots = np.flatnonzero(np.isin(digest, np.fromiter((k[1] for k in want), np.int64, len(want))))
                cols: list[list] = [[] for _ in names]
                for k, d, node in zip(spots.tolist(), doc[spots].tolist(), digest[spots].tolist(), strict=True):
                    x = want.pop((d, node), None)  # a line that the text repeats goes once
                    if x is not None:
                        grams = p.grams[p.line_start[k]:p.line_end[k] - SHINGLE + 1]
                        for c, v in zip(cols, (node, x["family"], x["chunk"], x["chunks"], np.unique(grams).tobytes()), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=names)

    return rows.mapInArrow(run, "doc_id long, family long, chunk int, chunks int, shingles binary")


def repeated_passages(docs: DataFrame, percent: int = PERCENT, recall: float = RECALL, cell: int = CELL, least: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, kind, start, n_words, from_byte, to_byte (UTF-8), class_id, run_words, kept: one row per place
    of every passage that two documents or more have; ``kept`` is true for its first place."""
    found = written(paragraphs(docs, bands(percent, recall)), "paragraphs")
    lines = found.filter("kind = 0")

    at_band = lines.select("digest", F.explode("sigs").alias("sig")).distinct()
    heads = at_band.groupBy("sig").agg(F.min("digest").alias("v"), F.max("digest").alias("top")).filter("v < top").drop("top")
    ties = at_band.join(written(heads, "heads"), "sig").filter("digest > v").select(F.col("digest").alias("u"), "v").distinct()
    place = lines.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumnRenamed("digest", "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.join(place, "node").groupBy("doc_id").agg(F.collect_list(F.struct("node", "family", "chunk", "chunks")).alias("wanted"))
        return _line_sets(texts.join(wanted, "doc_id").select("text", "wanted"))

    near = written(link_families(ties, sets_of, percent, cell), "near").select(F.lit(0).cast("byte").alias("kind"), F.col("node").alias("digest"), "component")

    first = F.struct("doc_id", "start")
    count = found.groupBy("kind", "digest").agg(F.min(first).alias("first"), F.max("doc_id").alias("last"))
    classes = (count.join(near, ["kind", "digest"], "left").filter((F.col("first.doc_id") < F.col("last")) | F.col("component").isNotNull())
               .select("kind", "digest", F.coalesce("component", "digest").alias("class_id"), "first", "last"))
    whole = classes.groupBy("kind", "class_id").agg(F.min("first").alias("first"), F.max("last").alias("last")).filter(F.col("first.doc_id") < F.col("last"))
    known = written(classes.select("kind", "digest", "class_id").join(whole.drop("last"), ["kind", "class_id"]), "passages")
    places = (found.drop("sigs").join(known, ["kind", "digest"])
              .select("doc_id", F.col("kind").cast("int").alias("kind"), "start", "n_words", "from_byte", "to_byte", "class_id", (F.col("first") == first).alias("kept")).distinct())
    before = Window.partitionBy("doc_id").orderBy("start", "n_words", "kind")
    end = F.col("start") + F.col("n_words")
    apart = F.col("start") > F.coalesce(F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = places.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "run")
    return (runs.withColumn("run_words", F.max(end).over(run) - F.min("start").over(run)).filter(F.col("run_words") >= least).drop("apart", "run"))


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs``, all columns, without the passages that aren't kept. Overlapping spans are cut once.
    Repeated rows of one id are cut alike."""
    spans = (passages.filter(~F.col("kept")).groupBy(F.col("doc_id").alias("__id"))
             .agg(F.sort_array(F.collect_set(F.struct("from_byte", "to_byte"))).alias("__cut")))
    order = [c for c in docs.columns]
    at = order.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cut in zip(batch.column(at).to_pylist(), batch.column(len(order)).to_pylist(), strict=True):
                if text is not None and cut:
                    data, parts, done = text.encode(), [], 0
                    for s in cut:
                        parts.append(data[done:max(done, s["from_byte"])])
                        done = max(done, s["to_byte"])
                    text = b"".join([*parts, data[done:]]).decode("utf-8")
                out.append(text)
            cols = [pa.array(out, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(len(order))]
            yield pa.RecordBatch.from_arrays(cols, names=order)

    joined = docs.join(spans, F.col("doc_id").cast("long") == F.col("__id"), "left").drop("__id")
    return joined.mapInArrow(run, docs.schema)
