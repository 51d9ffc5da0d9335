"""Quality rules by line labels: a linear-chain CRF marks each line of a document as content
or boilerplate (Viterbi decoding), and the share of words on content lines decides retention.

The two-state CRF is trained here, on the driver, from a bounded sample of labelled documents
(``TrainConfig``); decoding is one narrow pass over all whole texts, without a shuffle.

Defined results: a null or empty text has no words and no lines, all counts 0 and is rejected
by the base rule; a null id is passed through; repeated rows are judged one by one; an empty
table gives an empty table; without usable labels the fixed ``PRIOR`` weights are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .shared import hash_share

#: Symbols that running prose has few of (fixed by the result's definition).
SYMBOLS = "#*$%&|<>"
BOILERPLATE, CONTENT = 0, 1
FEATURES = ["bias", "symbols_per_word", "some_symbols", "many_symbols", "repeat_share", "mostly_repeats", "duplicate_line", "digit_share", "few_words", "log_words", "word_length", "ends_sentence"]

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;\"')"]] = True


@dataclass(frozen=True)
class TrainConfig:
    """``max_docs`` labelled documents of at most ``max_chars`` characters are the bounded
    sample that the CRF is fitted on (the first by hash of their id)."""

    max_docs: int = 1500
    max_chars: int = 8000
    steps: int = 120
    rate: float = 0.15
    l2: float = 1e-3


@dataclass(frozen=True)
class LineModel:
    """``emit`` [2, features], ``move`` [2, 2] (from, to), ``first`` [2]."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray
    min_content_share: float = field(default=0.5)


def prior() -> LineModel:
    """Weights for tables without labels: symbols, repeats and duplicate lines speak against."""
    emit = np.zeros((2, len(FEATURES)))
    emit[CONTENT, FEATURES.index("bias")] = 2.0
    emit[BOILERPLATE, FEATURES.index("many_symbols")] = 3.0
    emit[BOILERPLATE, FEATURES.index("mostly_repeats")] = 3.0
    emit[BOILERPLATE, FEATURES.index("duplicate_line")] = 1.0
    return LineModel(emit, np.array([[1.0, 0.0], [0.0, 1.0]]), np.zeros(2))


@dataclass
class Lines:
    """Lines with a word of a run of documents, in order, and the documents' base counts."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    words: np.ndarray
    features: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _sums(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=acc[1:])
    return acc[end] - acc[start]


def _repeated(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in their document."""
    out = np.zeros(len(doc) + 1, dtype=np.int64)
    at = np.flatnonzero(tv.whole_grams(doc, 3))
    if len(at):
        key = tv.gram_hashes(hashes, 3)[at] ^ tv.mix(doc[at].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(out, hit, 1)
        np.add.at(out, hit + 3, -1)
    return np.cumsum(out[:-1]) > 0


def read_lines(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    """Line features and base counts of each text (lines are parted by \\n alone)."""
    n = len(offsets) - 1
    w = tv.words_of(raw, offsets)
    repeated = _repeated(w.doc, w.hashes())
    newline = np.flatnonzero(raw == 10)
    start = np.unique(np.concatenate([offsets[:-1], newline + 1]))
    start = start[start < len(raw)]
    doc = np.searchsorted(offsets, start, side="right") - 1
    upto = np.append(newline, len(raw))
    end = np.minimum(upto[np.searchsorted(newline, start)], offsets[doc + 1])
    real = end > start
    start, end = start[real], end[real]
    first = np.searchsorted(w.start, start)
    words = np.searchsorted(w.start, end) - first
    real = words > 0
    start, end, first, words = start[real], end[real], first[real], words[real]
    doc = np.searchsorted(offsets, start, side="right") - 1
    key = tv.span_hashes(raw, start, end) ^ tv.mix(doc.astype(np.uint64))
    order = np.argsort(key, kind="stable")  # stable: the first of equal lines stays first
    dup = np.zeros(len(key), dtype=bool)
    dup[order[1:]] = key[order][1:] == key[order][:-1]
    symbols = _sums(_SYMBOL[raw], start, end)
    solid = ~tv._SPACE[raw] & ((raw & 0xC0) != 0x80)
    chars = _sums(solid, start, end)
    rep = _sums(repeated, first, first + words)
    last = w.end[first + words - 1] - 1 if len(first) else first
    per_word = symbols / np.maximum(words, 1)
    features = np.column_stack([
        np.ones(len(words)), np.minimum(per_word, 4.0) / 4.0, per_word > 0.25, per_word > 1.0, rep / np.maximum(words, 1),
        2 * rep > words, dup, _sums(_DIGIT[raw], start, end) / np.maximum(chars, 1), words < 4,
        np.log1p(words) / 5.0, np.minimum(chars / np.maximum(words, 1), 20.0) / 20.0,
        _STOP[raw[last]] if len(first) else np.zeros(0),
    ]) if len(words) else np.zeros((0, len(FEATURES)))
    by = lambda x: np.bincount(doc, weights=x, minlength=n).astype(np.int64)
    return Lines(doc, start, end, words, features.astype(np.float64), w.counts, by(chars),
                 _sums(_SYMBOL[raw], offsets[:-1], offsets[1:]), by(dup), by(rep))


def _time_major(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents' line counts and first lines, longest first, for recursions over all at once."""
    ids, first, count = np.unique(doc, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    return first[order], count[order]


def viterbi(lines: Lines, model: LineModel) -> np.ndarray:
    """The best label of every line. Ties go to content."""
    score = lines.features @ model.emit.T
    score[:, CONTENT] += 1e-9
    first, count = _time_major(lines.doc)
    out = np.zeros(len(score), dtype=np.int8)
    if not len(first):
        return out
    longest = int(count[0])
    active = np.searchsorted(-count, -np.arange(1, longest + 1), side="right")
    back = np.zeros((len(score), 2), dtype=np.int8)
    best = score[first] + model.first
    final = np.empty((len(first), 2))
    for t in range(1, longest):
        k, was = active[t], active[t - 1]
        final[k:was] = best[k:was]
        step = best[:k, :, None] + model.move[None]
        at = first[:k] + t
        back[at] = step.argmax(axis=1)
        best = step.max(axis=1) + score[at]
    final[:len(best)] = best
    label = final.argmax(axis=1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        at = first[:active[t]] + t
        out[at] = label[:active[t]]
        label[:active[t]] = back[at, label[:active[t]]]
    return out


def fit_crf(features: list[np.ndarray], labels: list[int], config: TrainConfig = TrainConfig()) -> LineModel:
    """Two fits by maximum likelihood. Only documents are labelled, and a bad document has good
    lines, too: the first fit (no transitions) gives each line its document's label; lines of
    bad documents that it finds to be content are relabelled, and the whole chain is fitted."""
    pairs = sorted(((f, int(y)) for f, y in zip(features, labels, strict=True) if len(f)), key=lambda p: -len(p[0]))
    if len({y for _, y in pairs}) < 2:
        return prior()
    count = np.array([len(f) for f, _ in pairs])
    x = np.concatenate([f for f, _ in pairs])
    y = np.repeat(np.array([y for _, y in pairs]), count)
    alone = _ascend(x, y, np.ones(len(x), dtype=np.int64), config)
    score = x @ (alone.emit[CONTENT] - alone.emit[BOILERPLATE])
    return _ascend(x, np.where((y == CONTENT) | (score > 0), CONTENT, BOILERPLATE), count, config)


def _ascend(x: np.ndarray, y: np.ndarray, count: np.ndarray, config: TrainConfig) -> LineModel:
    """Adam on the chain's mean log likelihood; ``count`` lines per chain, longest first."""
    first = tv.starts_of(count)[:-1]
    steps = int(count[0])
    active = np.searchsorted(-count, -np.arange(1, steps + 1), side="right")
    nf = x.shape[1]
    theta = np.zeros(2 * nf + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    gold = np.zeros((len(x), 2))
    gold[np.arange(len(x)), y] = 1
    inner = np.ones(len(x), dtype=bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (y[i - 1], y[i]), 1)
    gold_first = gold[first].sum(axis=0)
    for it in range(1, config.steps + 1):
        emit, move, start = theta[:2 * nf].reshape(2, nf), theta[2 * nf:2 * nf + 4].reshape(2, 2), theta[-2:]
        score = x @ emit.T
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[first] = score[first] + start
        for t in range(1, steps):
            at = first[:active[t]] + t
            alpha[at] = np.logaddexp(alpha[at - 1, 0][:, None] + move[0], alpha[at - 1, 1][:, None] + move[1]) + score[at]
        for t in range(steps - 1, 0, -1):
            at = first[:active[t]] + t
            nxt = beta[at] + score[at]
            beta[at - 1] = np.logaddexp(move[None, :, 0] + nxt[:, :1], move[None, :, 1] + nxt[:, 1:])
        logz = np.repeat(np.logaddexp(*(alpha[first + count - 1].T)), count)
        p = np.exp(alpha + beta - logz[:, None])
        pair = np.exp(alpha[i - 1][:, :, None] + move[None] + (score[i] + beta[i])[:, None, :] - logz[i][:, None, None])
        grad = np.concatenate([((gold - p).T @ x).ravel(), (gold_move - pair.sum(axis=0)).ravel(), gold_first - p[first].sum(axis=0)]) / len(x)
        grad -= config.l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + config.rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-8)
    return LineModel(theta[:2 * nf].reshape(2, nf), theta[2 * nf:2 * nf + 4].reshape(2, 2), theta[-2:])


def train(docs: DataFrame, labels: DataFrame, config: TrainConfig = TrainConfig()) -> LineModel:
    """Fit on the bounded sample: ``labels`` has doc_id and quality (1 good, 0 bad)."""
    picked = (hash_share(labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y")), "__id", config.max_docs)
              .filter(F.col("__y").isin(0, 1) & F.col("__id").isNotNull())
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(config.max_docs))
    rows = (docs.select("doc_id", "text").filter(F.length("text") <= config.max_chars)
            .join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
            .select("__id", "text", "__y").orderBy("__id", "__y", "text").limit(2 * config.max_docs).collect())
    features = []
    for r in rows:
        features.append(read_lines(*tv.texts_of(pa.array([r["text"]], pa.large_string()))).features)
    return fit_crf(features, [r["__y"] for r in rows], config)


def _judged(raw: np.ndarray, offsets: np.ndarray, model: LineModel) -> tuple[Lines, np.ndarray, np.ndarray, np.ndarray]:
    lines = read_lines(raw, offsets)
    label = viterbi(lines, model)
    n = len(offsets) - 1
    content = np.bincount(lines.doc, weights=lines.words * (label == CONTENT), minlength=n)
    share = content / np.maximum(lines.n_words, 1)
    failed = (lines.n_words < MIN_WORDS) | (100 * lines.n_repeat_words > MAX_REPEAT_PERCENT * lines.n_words)
    return lines, label, share, failed


def _by_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = tv.texts_of(batch.column(column))
    for a, b in tv.slices(offsets):
        o = offsets[a:b + 1]
        yield a, b, raw[o[0]:o[-1]], o - o[0]


def score_documents(docs: DataFrame, model: LineModel) -> DataFrame:
    """One row per row of ``docs``: base counts, ``content_share``, ``base_failed``, ``kept``."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines")),
        T.StructField("content_share", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in _by_slices(batch, "text"):
                x, label, share, failed = _judged(raw, offsets, model)
                n = b - a
                cols = [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words,
                        np.bincount(x.doc, minlength=n), np.bincount(x.doc, weights=label, minlength=n).astype(np.int64),
                        share, failed, ~failed & (share >= model.min_content_share)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, n), *map(pa.array, cols)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def retain(docs: DataFrame, model: LineModel) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in _by_slices(batch, "text"):
                _, _, share, failed = _judged(raw, offsets, model)
                yield batch.slice(a, b - a).filter(pa.array(~failed & (share >= model.min_content_share)))

    return docs.mapInArrow(run, docs.schema)


def label_lines(docs: DataFrame, model: LineModel) -> DataFrame:
    """One row per line with a word: doc_id, line_start and line_end (UTF-8 bytes), is_content."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("line_start", T.LongType()),
                           T.StructField("line_end", T.LongType()), T.StructField("is_content", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in _by_slices(batch, "text"):
                x = read_lines(raw, offsets)
                label = viterbi(x, model)
                ids = batch.column("doc_id").slice(a, b - a).take(pa.array(x.doc))
                yield pa.RecordBatch.from_arrays([ids, pa.array(x.start - offsets[x.doc]), pa.array(x.end - offsets[x.doc]), pa.array(label == CONTENT)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
