"""Language-model scoring with a hidden Markov model, trained and applied over the whole corpus.

A text is its words (A-Z lower-cased) and one end token. State z emits a word through its class:
``P(w | z) = E[z, class(w)] * P(w | class)``. The class is a hash of the word's last bytes, of
``CLASSES`` values (the end token has its own), so the parameters that Baum-Welch trains have a fixed
size; ``P(w | class) = (c + 0.1) / (C + 0.1 (V + 1))`` comes from the counts of all training words,
c the word's, C and V the class's tokens and distinct words. It doesn't depend on the state, so
a text's probability is its class sequence's, by the forward recursion, times its words'.

1. One pass writes the corpus as blocks: a block is the documents of a few MB as indices into
   the block's list of distinct words (64-bit hashes). Later passes read blocks, not texts.
2. Word counts: each block deals its words' counts out by hash; a part sums them over all blocks
   and sends every block back the counts of its own words, both as arrays. What moves grows
   with the distinct words of blocks, never with tokens, and no part holds more than a
   bounded number of words (``PART_WORDS`` each on average).
3. Baum-Welch: in every round each task computes the expected counts of its blocks (sequences are
   runs of ``SEGMENT`` tokens) as one fixed-size vector; the vectors are summed by position with a
   grouped aggregation, and the driver normalises the K * (CLASSES + K + 2) sums.
4. Scores: the scaled forward recursion over each whole text.

Training takes all documents with crc32(doc_id as text) mod 10 not 0 (a null id counts as "").

Defined results: a null or empty text is the end token alone; repeated rows are each trained on
and scored; without training documents all counts are 0 and the model is its start; an empty
table gives an empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .shared import written

STATES = 8
CLASSES = 2048
ROUNDS = 4
SEGMENT = 64
SUFFIX = 3
SMOOTH = 0.1
BLOCK_BYTES = 4 << 20
PART_WORDS = 400_000
END = np.uint64(0x5E0D5E0D5E0D5E0D)  # stands for the end token among the words' hashes


class Model(NamedTuple):
    start: np.ndarray  # [K]
    move: np.ndarray  # [K, K]
    emit: np.ndarray  # [K, CLASSES + 1]


def first_model(states: int = STATES, classes: int = CLASSES, seed: int = 7) -> Model:
    """Near-even emissions, which differ by chance, and states that tend to last."""
    rng = np.random.default_rng(seed)
    emit = rng.gamma(2.0, size=(states, classes + 1))
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))


def word_classes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each word: a hash of its last ``SUFFIX`` bytes."""
    code = np.zeros(len(start), dtype=np.uint64)
    for k in range(1, SUFFIX + 1):
        at = end - k
        code = code * np.uint64(257) + np.where(at >= start, raw[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return (tv.mix(code) % np.uint64(classes)).astype(np.int32)


class Block(NamedTuple):
    """``tokens`` are indices into ``words`` and ``classes``; every document ends with the end token."""

    tokens: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    classes: np.ndarray


def encode(raw: np.ndarray, offsets: np.ndarray, classes: int = CLASSES) -> Block:
    w = tv.words_of(raw, offsets, lower=True)
    h = w.hashes()
    words, first, which = np.unique(h, return_index=True, return_inverse=True)
    kinds = word_classes(w.raw, w.start[first], w.end[first], classes)
    bounds = tv.starts_of(w.counts + 1)
    tokens = np.full(int(bounds[-1]), len(words), dtype=np.uint32)
    mine = np.ones(len(tokens), dtype=bool)
    mine[bounds[1:] - 1] = False
    tokens[mine] = which
    return Block(tokens, bounds, np.append(words, END), np.append(kinds, np.int32(classes)))


def expected_counts(block: Block, held: np.ndarray, model: Model) -> np.ndarray:
    """Baum-Welch counts of the block's training documents: start, move and emit end to end."""
    k = len(model.start)
    out = [np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)]
    # Segments: runs of at most SEGMENT tokens of a document, longest first.
    size = np.where(held, 0, np.diff(block.bounds))
    runs = -(-size // SEGMENT)
    doc = np.repeat(np.arange(len(size)), runs)
    nth = np.arange(int(runs.sum())) - np.repeat(tv.starts_of(runs)[:-1], runs)
    begin = block.bounds[doc] + nth * SEGMENT
    length = np.minimum(SEGMENT, size[doc] - nth * SEGMENT)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    emit = np.ascontiguousarray(model.emit.T.astype(np.float32))
    move = model.move.astype(np.float32)
    for a in range(0, len(begin), 8192):  # bounds the recursion's arrays
        _segments(block, begin[a:a + 8192], length[a:a + 8192], model.start.astype(np.float32), move, emit, out)
    return np.concatenate([x.ravel() for x in out])


def _segments(block: Block, begin: np.ndarray, length: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray, out: list[np.ndarray]) -> None:
    steps, n, k = int(length[0]), len(begin), len(start)
    active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
    alpha = np.zeros((steps, n, k), dtype=np.float32)
    scale = np.ones((steps, n), dtype=np.float32)
    kinds = np.zeros((steps, n), dtype=np.int32)
    for t in range(steps):
        m = active[t]
        kinds[t, :m] = block.classes[block.tokens[begin[:m] + t]]
        x = (start if t == 0 else alpha[t - 1, :m] @ move) * emit[kinds[t, :m]]
        scale[t, :m] = x.sum(axis=1)
        alpha[t, :m] = x / scale[t, :m, None]
    beta = np.ones((n, k), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        gamma = alpha[t, :m] * beta[:m]
        for z in range(k):
            out[2][z] += np.bincount(kinds[t, :m], weights=gamma[:, z], minlength=emit.shape[0])
        if t == 0:
            out[0] += gamma.sum(axis=0)
        else:
            later = emit[kinds[t, :m]] * beta[:m] / scale[t, :m, None]
            out[1] += (alpha[t - 1, :m].T @ later) * move
            beta[:m] = later @ move.T


def normalised(sums: np.ndarray, like: Model) -> Model:
    """The next model from the summed counts, smoothed so that no class is impossible."""
    k, c = like.emit.shape
    start, move, emit = sums[:k] + SMOOTH, sums[k:k + k * k].reshape(k, k) + SMOOTH, sums[k + k * k:].reshape(k, c) + SMOOTH
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def forward(block: Block, model: Model) -> np.ndarray:
    """log10 probability of each document's whole class sequence, by the scaled recursion."""
    size = np.diff(block.bounds)
    order = np.argsort(-size, kind="stable")
    begin, length = block.bounds[:-1][order], size[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
    emit, move = np.ascontiguousarray(model.emit.T), model.move
    total = np.zeros(len(size))
    kinds = block.classes[block.tokens]
    x = None
    for t in range(steps):
        m = active[t]
        x = (np.broadcast_to(model.start, (m, len(model.start))) if t == 0 else x[:m] @ move) * emit[kinds[begin[:m] + t]]
        s = x.sum(axis=1)
        total[:m] += np.log10(s)
        x = x / s[:, None]
    out = np.empty(len(size))
    out[order] = total
    return out


def _read(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, Block, np.ndarray, pa.Array]]:
    for k in range(batch.num_rows):
        get = lambda c: batch.column(c)[k].as_py()  # noqa: E731, B023
        view = lambda c, kind: np.frombuffer(get(c), dtype=kind)  # noqa: E731, B023
        block = Block(view("tokens", np.uint32), view("bounds", np.int64), view("words", np.uint64), view("classes", np.int32))
        yield get("block"), block, np.array(get("held"), dtype=bool), batch.column("ids")[k].values


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows gathered to about BLOCK_BYTES of text; one long text may be more."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = tv.texts_of(batch.column(1))
        for a, b in tv.slices(offsets, BLOCK_BYTES):
            if held and size + int(offsets[b] - offsets[a]) > BLOCK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a])
    if held:
        yield pa.Table.from_batches(held)


def encoded(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """The corpus as blocks, written to the shared folder."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("held", T.ArrayType(T.BooleanType())),
                           *(T.StructField(c, T.BinaryType()) for c in ("tokens", "bounds", "words", "classes"))])
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in _blocks(batches):
            raw, offsets = tv.texts_of(part.column(1))
            x = encode(raw, offsets, classes)
            one = lambda v: pa.array([v.tobytes()], pa.binary())
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(c).combine_chunks()) for c in (0, 2)]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, one(x.tokens), one(x.bounds), one(x.words), one(x.classes)], names=schema.names)
            number += 1

    return written(docs.select("doc_id", F.col("text").cast("string").alias("text"), held.alias("held")).mapInArrow(run, schema), "encoded")


def train(blocks: DataFrame, states: int = STATES, rounds: int = ROUNDS, classes: int = CLASSES) -> Model:
    """Baum-Welch over all training documents; each round is one pass and one grouped sum."""
    model = first_model(states, classes)

    for _ in range(rounds):
        now = model

        def run(batches: Iterator[pa.RecordBatch], now: Model = now) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for _, block, held, _ in _read(batch):
                    x = expected_counts(block, held, now)
                    total = x if total is None else total + x
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

        sums = (blocks.select("block", "ids", "held", "tokens", "bounds", "words", "classes").mapInArrow(run, "sums array<double>")
                .select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect())
        if not sums:
            break
        model = normalised(np.array([r["x"] for r in sums]), model)
    return model


def _dealt(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, words, classes, counts) of every block: its distinct words of that part."""
    names = ["part", "block", "words", "classes", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, held, _ in _read(batch):
                per = np.repeat(~held, np.diff(block.bounds))
                n = np.bincount(block.tokens[per], minlength=len(block.words)).astype(np.uint32)
                part = (tv.mix(block.words) % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                edge = np.searchsorted(part[order], np.arange(parts + 1))
                cols: list[list] = [[] for _ in names]
                for p in range(parts):
                    at = order[edge[p]:edge[p + 1]]
                    if len(at):
                        for c, v in zip(cols, (p, number, block.words[at].tobytes(), block.classes[at].astype(np.uint16).tobytes(), n[at].tobytes()), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=names)

    return blocks.select("block", "ids", "held", "tokens", "bounds", "words", "classes").mapInArrow(run, "part int, block long, words binary, classes binary, counts binary")


def word_counts(blocks: DataFrame, classes: int = CLASSES) -> tuple[DataFrame, int]:
    """(part, block, counts, totals): for each block its words' training counts over the corpus, in
    the block's order within the part. ``totals``, on one row of a part, has the part's tokens and
    distinct words by class. With it the number of parts."""
    words = blocks.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    parts = max(1, int(words // PART_WORDS))

    def run(table: pa.Table) -> pa.Table:
        h = [np.frombuffer(x.as_py(), np.uint64) for x in table["words"]]
        n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["counts"]])
        kinds = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in table["classes"]])
        _, first, which = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        total = np.bincount(which, weights=n).astype(np.int64)
        back = np.split(total[which], np.cumsum([len(x) for x in h])[:-1])
        known = total > 0
        by_class = np.concatenate([np.bincount(kinds[first], weights=total, minlength=classes + 1), np.bincount(kinds[first][known], minlength=classes + 1)])
        totals = [by_class.tolist()] + [None] * (len(h) - 1)
        return pa.table({"part": table["part"], "block": table["block"], "counts": pa.array([x.tobytes() for x in back], pa.binary()),
                         "totals": pa.array(totals, pa.list_(pa.float64()))})

    return written(_dealt(blocks, parts).groupBy("part").applyInArrow(run, "part int, block long, counts binary, totals array<double>"), "counts"), parts


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    blocks = encoded(docs, classes)
    counts, parts = word_counts(blocks, classes)
    rows = (counts.filter("totals is not null").select(F.posexplode("totals").alias("at", "x"))
            .groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect())
    sums = np.array([r["x"] for r in rows]) if rows else np.zeros(2 * classes + 2)
    in_class, distinct = sums[:classes + 1], sums[classes + 1:]
    n_all, v_all = in_class.sum(), distinct.sum()
    model = train(blocks, states, rounds, classes)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()),
                           *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = {p: np.frombuffer(x, np.int64) for p, x in zip(right["part"].to_pylist(), right["counts"].to_pylist(), strict=True)}
        out = []
        for _, block, held, ids in _read(left.combine_chunks().to_batches()[0]):
            part = (tv.mix(block.words) % np.uint64(parts)).astype(np.int32)
            c = np.concatenate([got[p] for p in sorted(got)])
            count = np.empty(len(block.words), dtype=np.int64)
            count[np.argsort(part, kind="stable")] = c
            base = np.log10((count + SMOOTH) / (n_all + SMOOTH * (v_all + 1)))
            word = np.log10((count + SMOOTH) / (in_class + SMOOTH * (distinct + 1))[block.classes])
            per = lambda x: np.add.reduceat(x[block.tokens], block.bounds[:-1])  # noqa: E731, B023
            size = np.diff(block.bounds)
            out.append(pa.table({"doc_id": ids, "held_out": pa.array(held), "n_tokens": pa.array(size), "n_known": pa.array(per((count > 0).astype(np.int64))),
                                 "train_tokens": pa.array(np.full(len(size), int(n_all))), "base_score": pa.array(per(base)), "score": pa.array(per(word) + forward(block, model))}))
        return pa.concat_tables(out)

    return blocks.groupBy("block").cogroup(counts.select("part", "block", "counts").groupBy("block")).applyInArrow(run, schema)
