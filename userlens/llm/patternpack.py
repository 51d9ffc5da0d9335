"""Best-fit packing by patterns: a sequence's make-up is a pattern (a few lengths, each so many times),
and how often each pattern is used is a non-negative least-squares fit to the histogram of lengths.

1. One narrow pass tokenizes whole texts, cuts only documents beyond ``room`` (full pieces, the first
   one may be shorter), and writes one small row per piece. A row knows its task and its number
   among the task's pieces of its length.
2. The histogram of lengths (at most ``room`` numbers, whatever the table's size) goes to one task.
   Patterns of two or three lengths that fill a sequence are enumerated, their repeat counts fitted by an
   active-set method, rounded, and held within the histogram; then once more for what is left, with
   patterns that fill a sequence nearly. What is left after both is packed best-fit decreasing, again as repeated patterns: each step uses up a length, so the
   plan's size and time depend on ``room`` alone.
3. A piece's rank among all pieces of its length (a running sum of the tasks' counts, joined back) picks
   its slot: pattern, repetition and place are arithmetic on the rank. No text is shuffled, and no
   sequence is gathered anywhere.

Defined results: a null or empty text has the end id alone; a null id stays; repeated rows are packed
each; an empty table gives an empty table; other columns, whatever their names, are not looked at.
``sequence_id`` runs from 0.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .shared import written
from .tokencount import byte_alphabet, load, unit_starts
from .wordcache import IdCache

ROOM = 1024
END_ID = 2
#: Parts of a sequence that the patterns of each fit may leave empty.
SLACKS = (0.0, 1 / 64)
#: Rounds of a fit, patterns that enter it in a round, and the share of the error that a round must take away.
ROUNDS, ENTER, GAIN = 60, 64, 0.05
#: Shares of the fitted repeats that are tried; the last leaves all to best fit.
SHARES = (1.0, 0.95, 0.85, 0.7, 0.5, 0.25, 0.0)
#: Pieces of one length and task that are joined to their rank under one key.
BLOCK = 256


# ---- the plan: patterns and how often each is used -------------------------------------------------

def patterns(counts: np.ndarray, room: int, slack: float = SLACKS[-1]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, times), each of shape (patterns, 3), unused places 0: pairs, triples, and several of
    one length with a filler, of lengths below ``room`` that the histogram has, with at most ``slack`` of
    ``room`` left empty."""
    have = np.flatnonzero(counts[:room] > 0)
    have = have[have > 0]
    if not len(have):
        return np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)
    fill = np.zeros(room + 1, np.int64)  # the longest length that fits
    fill[have] = have
    fill = np.maximum.accumulate(fill)
    least = room - int(room * slack)
    rows = []
    for k in range(1, room // int(have[0]) + 1):
        a = have[have * k <= room]
        rows.append(np.stack([a, np.full_like(a, k), fill[room - a * k], np.ones_like(a), 0 * a, 0 * a], axis=1))
    for a in have:
        b = have[(have < a) & (have + a <= room)]
        c = fill[room - a - b]
        ok = (c > 0) & (c < b)
        b, c = b[ok], c[ok]
        one = np.ones_like(b)
        rows.append(np.stack([np.full_like(b, a), one, b, one, c, one], axis=1))
    all_rows = np.concatenate(rows)
    length, times = all_rows[:, 0::2].copy(), all_rows[:, 1::2].copy()
    times[length == 0] = 0
    same = length[:, 0] == length[:, 1]
    times[same, 0] += times[same, 1]
    length[same, 1] = times[same, 1] = 0
    used = (length * times).sum(axis=1)
    ok = (used >= least) & (used <= room)
    both = np.unique(np.concatenate([length[ok], times[ok]], axis=1), axis=0)
    return both[:, :3], both[:, 3:]


def fit(length: np.ndarray, times: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, repeats > 0) of the least-squares fit of repeats >= 0 to the histogram. In each round the
    patterns with the steepest descent that share no length enter the active set; the set is solved
    without bounds, and patterns that would turn negative leave it on the way."""
    h = counts.astype(np.float64)
    norm = np.sqrt((times.astype(np.float64) ** 2).sum(axis=1))
    active = np.zeros(0, np.int64)
    x = np.zeros(0)
    columns, gram = np.zeros((len(h), 0)), np.zeros((0, 0))
    for _ in range(rounds):
        rest = h - columns @ x
        rest[0] = 0.0
        score = (rest[length] * times).sum(axis=1) / np.maximum(norm, 1.0)
        score[active] = -1.0
        taken: set[int] = {0}
        enter = []
        for p in np.argsort(-score, kind="stable")[:ENTER * 32]:
            if score[p] <= 0.25 or len(enter) == ENTER:
                break
            mine = {int(k) for k in length[p]} - {0}
            if not mine & taken:
                taken |= mine
                enter.append(int(p))
        if not enter:
            break
        before = float(rest @ rest)
        new = np.zeros((len(h), len(enter)))
        for j, p in enumerate(enter):
            np.add.at(new[:, j], length[p], times[p])
        new[0] = 0.0
        cross, own = columns.T @ new, new.T @ new
        own[np.diag_indices_from(own)] *= 1 + 1e-9
        gram = np.block([[gram, cross], [cross.T, own]])
        active, x, columns = np.append(active, enter), np.append(x, np.zeros(len(enter))), np.concatenate([columns, new], axis=1)
        while len(active):
            s = np.linalg.solve(gram, columns.T @ h)
            if (s > 1e-9).all():
                x = s
                break
            low = s <= 1e-9
            step = min(1.0, float((x[low] / np.maximum(x[low] - s[low], 1e-12)).min()))
            x = x + step * (s - x)
            keep = ~(low & (x <= 1e-9))
            if keep.all():
                keep[np.flatnonzero(low)[np.argmin(x[low])]] = False
            active, x, columns, gram = active[keep], x[keep], columns[:, keep], gram[np.ix_(keep, keep)]
        rest = h - columns @ x
        rest[0] = 0.0
        if before - float(rest @ rest) <= GAIN * before:
            break
    return active, x


class Plan(NamedTuple):
    """``patterns``: each a list of (length, times), and ``repeats``."""

    patterns: list[list[tuple[int, int]]]
    repeats: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.repeats)


def best_fit(left: dict[int, int], room: int) -> Plan:
    """The pieces left, longest first, each sequence filled up with the longest that fit; the same
    make-up again as often as the pieces last."""
    out: list[list[tuple[int, int]]] = []
    repeats: list[int] = []
    have = np.zeros(room + 1, bool)
    for k, n in left.items():
        have[k] = n > 0
    while have.any():
        free, parts = room, []
        at = room
        while free > 0:
            some = np.flatnonzero(have[1:min(free, at) + 1])
            if not len(some):
                break
            k = int(some[-1]) + 1
            m = min(free // k, left[k])
            parts.append((k, m))
            free -= k * m
            at = k - 1
        n = min(left[k] // m for k, m in parts)
        for k, m in parts:
            left[k] -= n * m
            have[k] = left[k] > 0
        out.append(parts)
        repeats.append(n)
    return Plan(out, repeats)


def _round(length: np.ndarray, times: np.ndarray, x: np.ndarray, left: np.ndarray) -> Plan:
    """The repeats ``x`` of patterns as whole numbers that ``left`` holds; ``left`` is lowered by them."""
    out: list[list[tuple[int, int]]] = []
    repeats: list[int] = []
    for i in np.argsort(-x, kind="stable"):
        parts = [(int(k), int(m)) for k, m in zip(length[i], times[i], strict=True) if m]
        n = min([int(x[i] + 0.5), *(int(left[k]) // m for k, m in parts)])
        if n > 0:
            out.append(parts)
            repeats.append(n)
            for k, m in parts:
                left[k] -= n * m
    return Plan(out, repeats)


def plan(counts: np.ndarray, room: int) -> Plan:
    """How to pack ``counts[k]`` pieces of each length k <= room. Of the fit's repeats, a share is held back
    for the residual, whose odd lengths then find partners; the share with the fewest sequences is taken."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    full = Plan([[(room, 1)]], [int(left[room])]) if left[room] else Plan([], [])
    left[room] = 0
    fits, rest = [], left.copy()
    for slack in SLACKS:
        length, times = patterns(rest, room, slack)
        if len(length):
            which, x = fit(length, times, rest)
            fits.append((length[which], times[which], x))
            _round(*fits[-1], rest)
    plans = []
    for share in SHARES:
        rest = left.copy()
        fitted = [_round(length, times, x * share, rest) for length, times, x in fits]
        plans.append([*fitted, best_fit({int(k): int(rest[k]) for k in np.flatnonzero(rest)}, room)])
    best = min(plans, key=lambda ps: sum(p.sequences for p in ps))
    return Plan(sum((p.patterns for p in best), full.patterns), sum((p.repeats for p in best), full.repeats))


class Slots:
    """Where the piece of a length and rank goes."""

    def __init__(self, p: Plan) -> None:
        rows, taken, first = [], {}, 0
        for parts, n in zip(p.patterns, p.repeats, strict=True):
            offset = 0
            for k, m in parts:
                rows.append((k, taken.get(k, 0), m, first, offset))
                taken[k] = taken.get(k, 0) + n * m
                offset += k * m
            first += n
        rows.sort()
        t = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.length, self.rank, self.times, self.first, self.offset = t.T
        self.key = (self.length << 44) + self.rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        i = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        nth = rank - self.rank[i]
        return self.first[i] + nth // self.times[i], self.offset[i] + (nth % self.times[i]) * length


# ---- tokens ----------------------------------------------------------------------------------------

#: The split of a byte-level vocabulary's texts before merging. Fixed value.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):
    """Units of text -> their ids. ASCII units are merged by rank where the file's merges are in the order of
    their ids, which is checked; other units, and special strings, go to the file's own library."""
    t = load(path)
    specials = [x.content for x in t.get_added_tokens_decoder().values()]
    model = json.loads(t.to_str())["model"]
    vocab, alphabet = model["vocab"], byte_alphabet()
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model["merges"]]
    ranks = {bytes(alphabet[c] for c in k): i for k, i in vocab.items() if k not in specials and all(c in alphabet for c in k)}
    ordered = None not in merged and all(a < b for a, b in zip(merged, merged[1:])) and len(ranks) == len(set(ranks.values()))
    fast = None
    if ordered and merged and merged[0] == 256:
        import tiktoken

        fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(units: list[str]) -> list[list[int]]:
        plain = [fast is not None and u.isascii() and not any(s in u for s in specials) for u in units]
        rest = iter(t.encode_batch_fast([u for u, p in zip(units, plain, strict=True) if not p], add_special_tokens=False))
        return [fast(u) if p else next(rest).ids for u, p in zip(units, plain, strict=True)]

    return encode, [s.encode() for s in specials]


#: The tokenizers of this Python worker, with the ids of units that it has met, and special strings.
_CACHES: dict[str, tuple[IdCache, list[bytes]]] = {}


def _cache(path: str) -> tuple[IdCache, list[bytes]]:
    if path not in _CACHES:
        encode, specials = encoder(path)
        _CACHES[path] = IdCache(encode, 2_000_000), specials
    return _CACHES[path]


def document_ids(raw: np.ndarray, offsets: np.ndarray, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each text's with ``end_id``, and their bounds."""
    cache, specials = _cache(path)
    start = unit_starts(raw, offsets, specials)
    end = np.append(start[1:], len(raw)).astype(np.int64) if len(start) else start
    ids, n = cache.ids(raw, start, end, tv.span_hashes(raw, start, end)) if len(start) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    doc = np.searchsorted(offsets, start, side="right") - 1
    per = np.bincount(doc, weights=n, minlength=len(offsets) - 1).astype(np.int64)
    bounds = tv.starts_of(per + 1)
    out = np.full(int(bounds[-1]), end_id, dtype="<u4")
    mine = np.ones(len(out), dtype=bool)
    mine[bounds[1:] - 1] = False
    out[mine] = ids
    return out, bounds


# ---- Spark -----------------------------------------------------------------------------------------

def pieces_of(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, doc_tokens, and ``part`` and ``nth``, the task
    and the piece's number among that task's pieces of its length."""
    names = ["piece", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.IntegerType() if c in ("piece", "part") else T.LongType()) for c in names)])
    kinds = [pa.int32() if c in ("piece", "part") else pa.int64() for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(room + 1, np.int64)
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                ids, bounds = document_ids(raw[o[0]:o[-1]], o - o[0], tokenizer, end_id)
                size = np.diff(bounds)
                n = -(-size // room)
                first = size - (n - 1) * room
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(int(n.sum())) - np.repeat(tv.starts_of(n)[:-1], n)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * room)
                length = np.where(piece == 0, first[doc], room)
                at = bounds[doc] + start
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(at.tolist(), (at + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run_of = np.bincount(length, minlength=room + 1)
                nth = np.empty_like(length)
                nth[order] = seen[length[order]] + np.arange(len(order)) - tv.starts_of(run_of)[:-1][length[order]]
                seen += run_of
                columns = [piece, start, length, crc, size[doc], np.full(len(doc), part), nth]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(doc)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def planned(histogram: DataFrame, room: int) -> Plan:
    """The plan for (length, n), at most ``room`` rows, made in one task (where numpy has one thread)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(room + 1, np.int64)
        for batch in batches:
            length, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "n"))
            counts[length] += n
        made = plan(counts, room)
        parts = pa.array([[x for part in p for x in part] for p in made.patterns], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), parts, pa.array(made.repeats, pa.int64())], names=["id", "parts", "n"])

    rows = sorted(histogram.coalesce(1).mapInArrow(run, "id long, parts array<long>, n long").collect())
    return Plan([list(zip(r["parts"][::2], r["parts"][1::2], strict=True)) for r in rows], [r["n"] for r in rows])


def place(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """``pieces`` (a written table with length, part and nth) with sequence_id and offset."""
    per = pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    per = written(per, "lengths")
    slots = Slots(planned(per.groupBy("length").agg(F.sum("n").alias("n")), room))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (per.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .select("part", "length", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("block")))
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    ranked = (pieces.withColumn("block", F.floor(F.col("nth") / BLOCK)).join(ranks, ["part", "length", "block"])
              .select(*kept, (F.col("before") + F.col("nth")).alias("rank")))
    schema = T.StructType([*pieces.select(*kept).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = slots.place(length, rank)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece of ``docs``
    (doc_id, text), in sequences of at most ``room`` tokens."""
    return place(written(pieces_of(docs, tokenizer, room, end_id), "pieces"), room)
