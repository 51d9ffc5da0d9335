"""Packing by vector bin packing: an example is a vector (tokens, one segment, loss-bearing
tokens), a sequence a bin with a limit on each, and a bin takes the example with the largest
dot product of its vector and what is left of the bin, both as shares of the limits.

Documents are tokenized and packed in one narrow pass; a task packs what it reads, with a pool of
examples that runs on from batch to batch, so nothing is shuffled and memory is bounded by a
batch and the pool: ``POOL`` examples, or as many short ones as fill ``FULL`` bins. Only the last sequences of a task are short.

With ``cut`` (plain documents) an example may be cut where no whole one fits, which fills every
bin; the last tokens of a task go to sequences of a power of two. Without it (instruction data)
examples stay whole, and one beyond a limit is cut into parts of the limit first.

Defined results: a null or empty text has the end id alone; a null id stays; repeated rows are
packed each; an empty table gives an empty table; other columns, whatever their names, are not
looked at. ``sequence_id`` is the task's number times 2^33 plus a running number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .wordcache import IdCache

END_ID = 1
POOL = 256
#: Bins' worth of tokens that the pool holds at least before a bin is filled from it.
FULL = 2
#: Words whose ids a Python worker keeps; a worker goes on to other tasks and stages with them.
WORDS_KEPT = 1_000_000


class Limits(NamedTuple):
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Packer:
    """Examples go in with their size and loss; pieces (example, start, length, sequence, offset)
    come out. ``keep`` examples stay in the pool until ``finish``."""

    def __init__(self, limits: Limits, cut: bool, keep: int = POOL) -> None:
        self.limits, self.cut, self.keep = limits, cut, keep
        self.key = np.zeros(0, np.int64)
        self.start, self.size, self.loss = (np.zeros(0, np.int64) for _ in range(3))
        self.sequence = 0

    def add(self, key: np.ndarray, size: np.ndarray, loss: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Parts that fill a bin leave at once; the rest joins the pool."""
        out: list[tuple[int, int, int, int, int]] = []
        most = min(self.limits.tokens, self.limits.loss) if (loss > self.limits.loss).any() else self.limits.tokens
        start = np.zeros_like(size)
        for i in np.flatnonzero(size >= most):
            while size[i] >= most:
                out.append((int(key[i]), int(start[i]), most, self.sequence, 0))
                self.sequence += 1
                part = min(int(loss[i]), most)
                start[i], size[i], loss[i] = start[i] + most, size[i] - most, loss[i] - part
        left = size > 0
        for name, new in (("key", key), ("start", start), ("size", size), ("loss", np.minimum(loss, size))):
            setattr(self, name, np.concatenate([getattr(self, name), new[left]]))
        tokens = int(self.size.sum())
        while len(self.key) > self.keep and tokens >= FULL * self.limits.tokens:  # many short ones must fill a bin, too
            out += self._bin()
            tokens = int(self.size.sum())
        return out

    def finish(self) -> list[tuple[int, int, int, int, int]]:
        out: list[tuple[int, int, int, int, int]] = []
        while len(self.key):
            total = int(self.size.sum())
            room = self.limits.tokens
            if self.cut and total < room:
                room = 1 << (total.bit_length() - 1)  # the largest power of two that can be filled
            out += self._bin(room)
        return out

    def _bin(self, room: int | None = None) -> list[tuple[int, int, int, int, int]]:
        cap = np.array([room or self.limits.tokens, self.limits.segments, self.limits.loss], dtype=np.float64)
        rest = cap.copy()
        out: list[tuple[int, int, int, int, int]] = []
        at = 0
        while len(self.key) and rest[1] >= 1 and rest[0] >= 1:
            fits = (self.size <= rest[0]) & (self.loss <= rest[2])
            score = self.size * (rest[0] / cap[0] ** 2) + self.loss * (rest[2] / cap[2] ** 2)  # the segment's share is equal for all
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                n, loss = int(self.size[i]), int(self.loss[i])
            elif self.cut:
                i = int(np.argmax(score))
                n = int(min(rest[0], self.size[i]))
                loss = min(n, int(self.loss[i]))
                if loss > rest[2]:
                    n = loss = int(rest[2])
                if n < 1:
                    break
            else:
                break
            out.append((int(self.key[i]), int(self.start[i]), n, self.sequence, at))
            at += n
            rest -= (n, 1, loss)
            if n == self.size[i]:
                last = len(self.key) - 1
                for x in (self.key, self.start, self.size, self.loss):
                    x[i] = x[last]
                self.key, self.start, self.size, self.loss = (x[:last] for x in (self.key, self.start, self.size, self.loss))
            else:
                self.start[i] += n
                self.size[i] -= n
                self.loss[i] -= loss
        self.sequence += 1
        return out


#: The tokenizers of this Python worker, with the ids of words that it has met.
_CACHES: dict[str, IdCache] = {}


def _cache(path: str) -> IdCache:
    if path not in _CACHES:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads each keep memory
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _CACHES[path] = IdCache(lambda words: [e.ids for e in t.encode_batch_fast(words, add_special_tokens=False)], WORDS_KEPT)
    return _CACHES[path]


def document_ids(raw: np.ndarray, offsets: np.ndarray, cache: IdCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each text's with END_ID, and their bounds.

    The tokenizer parts words at white space and drops it, and lowers case, so a text's ids are
    its words' ids. Case is lowered before, for fewer distinct words, unless a special token's
    string may be there, which is looked for in the text as it is."""
    w = tv.words_of(raw, offsets, lower=b"<|" not in raw.tobytes())
    ids, n = cache.ids(w.raw, w.start, w.end, w.hashes())
    per = np.bincount(w.doc, weights=n, minlength=len(offsets) - 1).astype(np.int64)
    bounds = tv.starts_of(per + 1)
    out = np.full(int(bounds[-1]), END_ID, dtype=np.uint32)
    mine = np.ones(len(out), dtype=bool)
    mine[bounds[1:] - 1] = False
    out[mine] = ids
    return out, bounds


def _pieces(docs: DataFrame, path: str, limits: Limits, cut: bool, id_type: T.DataType) -> DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(c, T.LongType()) for c in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, cache = Packer(limits, cut), _cache(path)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, tuple[object, np.ndarray]] = {}  # documents with tokens in the pool
        count = 0

        def rows(pieces: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in names]
            for key, start, length, sequence, offset in pieces:
                doc, ids = held[key]
                crc = zlib.crc32(ids[start:start + length].tobytes())
                for c, x in zip(cols, (doc, start, length, crc, len(ids), base + sequence, offset), strict=True):
                    c.append(x)
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, [id_kind, *[pa.int64()] * 6], strict=True)], names=names)

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.schema.field(0).type
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                ids, bounds = document_ids(raw[o[0]:o[-1]], o - o[0], cache)
                keys = np.arange(count, count + b - a)
                count += b - a
                for k, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    held[int(keys[k])] = (doc, ids[bounds[k]:bounds[k + 1]])
                size = np.diff(bounds)
                yield rows(packer.add(keys, size.copy(), size.copy()))
                # Copies let go of the batch's ids.
                held = {int(k): (held[int(k)][0], held[int(k)][1].copy()) for k in packer.key}
        if count:
            yield rows(packer.finish())

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


#: Plain documents: short ones may fill a sequence, as a segment has a token at least.
PLAIN = Limits(segments=Limits().tokens)


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = PLAIN, cut: bool = True) -> DataFrame:
    """One row per piece: doc_id, start (in its document's ids), length, ids_crc32, doc_tokens (with
    the end id), sequence_id, offset (in the sequence, without gaps from 0)."""
    return _pieces(docs, tokenizer, limits, cut, docs.schema["doc_id"].dataType)


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Instruction data: ``examples`` has example_id, tokens and loss_tokens; examples stay whole. One row
    per piece: example_id, start, length, sequence_id, offset. Null counts are 0; an example of no
    tokens has no piece; loss beyond the tokens counts as the tokens."""
    names = ["example_id", "start", "length", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("example_id", examples.schema["example_id"].dataType), *(T.StructField(c, T.LongType()) for c in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, count = Packer(limits, cut=False, keep=POOL), TaskContext.get().partitionId() << 33, 0
        held: dict[int, object] = {}
        kind = pa.int64()

        def rows(pieces: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
            cols = [[held[p[0]] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], [base + p[3] for p in pieces], [p[4] for p in pieces]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [kind, *[pa.int64()] * 4], strict=True)], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            n = batch.num_rows
            size = np.maximum(batch.column(1).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            loss = np.minimum(np.maximum(batch.column(2).to_numpy(zero_copy_only=False), 0), size).astype(np.int64)
            held |= dict(zip(range(count, count + n), batch.column(0).to_pylist(), strict=True))
            out = rows(packer.add(np.arange(count, count + n), size.copy(), loss.copy()))
            count += n
            held = {int(k): held[int(k)] for k in packer.key}
            yield out
        if count:
            yield rows(packer.finish())

    return examples.select("example_id", F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"), F.coalesce(F.col("loss_tokens").cast("long"), F.lit(0)).alias("loss_tokens")).mapInArrow(run, schema)
