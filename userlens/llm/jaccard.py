"""N-gram Jaccard join by T-occurrence search (DivideSkip), exact on whole texts.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct
``words``-word shingles (64-bit hashes of lower-cased words).

1. One narrow pass per document: the set's size, a 128-bit digest of the set, and segment
   signatures. Equal digests are one class; its smallest doc_id stands for it from here on, and
   a task emits the signatures of a class once, so a group of copies never meets as copies.
2. Signatures only say which classes may meet (no link is lost): linked sets differ in at most
   k = floor((100 - percent) * a / percent) shingles, a the smaller size. Sizes fall into levels
   so that linked sets share a level; a level cuts the hash space into k + 1 + s segments, so that
   s + 1 segments at least are equal, and one of them isn't empty unless the set has more than
   s empty ones (then these count, too); s grows with the segments, so that few sets have (``spares``).
   Classes that share a signature form a family. Signatures are sorted by range with their documents, so a
   signature of many classes lies over several tasks; a task joins the documents of each signature, hands out
   what it has joined as stars, and the tasks' first and last rows tie a signature across tasks.
   With ``prune``, only sets that may link at all are asked for signatures: of linked sets at most (100 - percent)
   percent of either's shingles are in no other set. Shingles of a fixed share of the hash space (``SAMPLE``) are
   sorted by range, those that one class alone has are counted per class, and a class with more of them than that
   bound goes; so sets that merely share a passage with many others form no family. Families
   are then parted (``parted``): in the order of the family's own frequencies, rare first, linked sets
   share one of their first n - ceil(percent * n / 100) + 1 shingles, n the size. No link is lost.
3. A family's sets meet in cells of at most ``cell`` sets a side: a small family is one cell, a
   large one a triangle of cells, so no group meets in one task. A cell is an inverted index
   (shingle -> sorted list of sets). For each set T shingles must be shared; the L longest lists
   are put aside, the short ones merged by a heap (many elements: by a merge sort) for candidates with T - L occurrences, and the
   candidates probed in the long lists by binary search; the exact condition decides. Sets that
   the cell already knows to be connected aren't probed again, and a cell emits a forest, not pairs.
4. Links become components by grouped minima and joins (``shared.components``).

Defined results: a null or empty text, or one without words, has the empty set, links with
nothing and is its own component; fewer than ``words`` words are one shingle; a row without
doc_id links with nothing and gets a null component; repeated rows are one class; rows that
share an id but not a text each follow their own text. Empty tables give empty tables; other
columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import merge
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import components, contract, dropped, release, written, written_at

WORDS = 3
PERCENT = 90
CELL = 512
#: Weight of a binary probe against a step of the heap, in the choice of L (from the method's paper).
MU = 0.0085
#: Share of the hash space whose shingles are looked at before signatures are (``prune``).
SAMPLE = 0.4
#: Segments beyond those that differences may touch, at least (see ``spares``).
SPARE = 2


def levels(percent: int, most: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size levels: linked sets lie in one level or in two neighbours."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, 100 * out[-1] // percent + 1))
    return np.array(out, dtype=np.int64)


@lru_cache
def spares(percent: int) -> np.ndarray:
    """Spare segments of each size level: as many as the empty segments that a level's smallest set is
    expected to have, with three deviations; while a segment has two shingles on average."""
    ends = levels(percent)
    out = []
    for least, after in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        must, s = (100 - percent) * (after - 1) // percent + 1, SPARE
        while 2 * (must + s) < least:
            empty = (must + s) * (1 - 1 / (must + s)) ** least
            more = min(ceil(empty + 3 * sqrt(empty)), least // 2 - must)
            if more <= s:
                break
            s = more
        out.append(s)
    return np.array(out, dtype=np.int64)


def least_size(percent: int) -> int:
    """Size from which a set may link with another than its equals."""
    ends = levels(percent)
    return int(ends[np.flatnonzero((100 - percent) * (ends[1:] - 1) // percent > 0)[0]])


def signatures(sets: np.ndarray, bounds: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Segment signatures of each set and their counts per set (a set that links only with its
    equals has none)."""
    ends = levels(percent)
    size = np.diff(bounds)
    level = np.searchsorted(ends, size, side="right") - 1
    value, owner = [], []
    for lv in (level, level - 1):
        k = (100 - percent) * (ends[np.maximum(lv, 0) + 1] - 1) // percent
        use = np.flatnonzero((lv >= 0) & (size > 0) & (k > 0))
        if not len(use):
            continue
        spare = spares(percent)[lv[use]]
        m = (k[use] + 1 + spare).astype(np.uint64)
        n = size[use]
        at = np.repeat(bounds[use], n) + _ramp(n)
        who = np.repeat(np.arange(len(use)), n)
        x = sets[at]
        part = ((x >> np.uint64(32)) * m[who]) >> np.uint64(32)  # ascending, as the set is sorted
        edge = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (who[1:] != who[:-1])]))
        total = np.add.reduceat(tv.mix(x + np.uint64(0x51ED27)), edge)
        who, part = who[edge], part[edge]
        empties = m.astype(np.int64) - np.bincount(who, minlength=len(use))
        for d in np.flatnonzero(empties > spare):
            gone = np.setdiff1d(np.arange(int(m[d]), dtype=np.uint64), part[who == d])
            total, part = np.concatenate([total, np.zeros(len(gone), np.uint64)]), np.concatenate([part, gone])
            who = np.concatenate([who, np.full(len(gone), d)])
        tag = (lv[use][who].astype(np.uint64) << np.uint64(40)) + part
        value.append(tv.mix(total ^ tv.mix(tag + np.uint64(1))))
        owner.append(use[who])
    if not value:
        return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
    v, o = np.concatenate(value), np.concatenate(owner)
    return v[np.argsort(o, kind="stable")].view(np.int64), np.bincount(o, minlength=len(size)).astype(np.int64)


def _ramp(n: np.ndarray) -> np.ndarray:
    return np.arange(int(n.sum())) - np.repeat(tv.starts_of(n)[:-1], n)


def _digests(sets: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _profiles(docs: DataFrame, words: int, percent: int, prune: bool) -> DataFrame:
    names = ["doc_id", "n_words", "n_shingles", "digest", "sigs", "sample"]
    below, least = np.uint64(int(SAMPLE * (1 << 64))) if prune else np.uint64(0), least_size(percent)

    def of_fresh(values: np.ndarray, n: np.ndarray, fresh: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(tv.starts_of(np.where(fresh, n, 0)).astype(np.int32)), pa.array(values[np.repeat(fresh, n)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                sets, bounds, counts = tv.shingle_sets(raw[o[0]:o[-1]], o - o[0], words)
                digests = _digests(sets, bounds)
                value, n = (np.zeros(0, np.int64), np.zeros(b - a, np.int64)) if prune else signatures(sets, bounds, percent)
                size = np.diff(bounds)
                has_id = batch.column(0).slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)
                fresh = np.zeros(b - a, dtype=bool)
                for k, d in enumerate(digests):
                    if has_id[k] and size[k] >= least and d not in seen:
                        seen.add(d)
                        fresh[k] = True
                low = sets < below
                mine = np.bincount(np.repeat(np.arange(b - a), size)[low], minlength=b - a).astype(np.int64)
                sample = of_fresh(sets[low].view(np.int64), mine, fresh)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts), pa.array(size), pa.array(digests, pa.binary()), of_fresh(value, n, fresh), sample], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_shingles long, digest binary, sigs array<long>, sample array<long>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """Rows (text, digest, ...) whose text has that digest, with the set as bytes for both."""
    kept = [c for c in rows.columns if c not in ("text", "digest")]
    names = [*kept, "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column("text"))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                sets, bounds, _ = tv.shingle_sets(raw[o[0]:o[-1]], o - o[0], words)
                part = batch.slice(a, b - a)
                same = pa.array([x == y for x, y in zip(_digests(sets, bounds), part.column("digest").to_pylist(), strict=True)], pa.bool_())
                data = pa.array([sets[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), data], names=names).filter(same)

    return rows.mapInArrow(run, ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept), "shingles binary"]))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds) of sets as bytes, laid end to end."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint64, offset=int(off[0]), count=int(off[-1] - off[0]) // 8), (off - off[0]) // 8


def _signed(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, sigs) of (doc_id, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                value, n = signatures(*_flat(batch.column("shingles")), percent)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(tv.starts_of(n).astype(np.int32)), pa.array(value))], names=["doc_id", "sigs"])

    return sets.mapInArrow(run, "doc_id long, sigs array<long>")


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


#: Elements up to which lists are merged by the heap; beyond, by a merge sort of their sorted runs.
HEAP_MOST = 400


def _merged(lists: list[list[int]]) -> list[tuple[int, int]]:
    """(element, number of lists that have it), ascending: a k-way merge of sorted lists."""
    if sum(map(len, lists)) > HEAP_MOST:
        x, n = np.unique(np.sort(np.concatenate([np.array(k, dtype=np.int64) for k in lists]), kind="stable"), return_counts=True)
        return list(zip(x.tolist(), n.tolist(), strict=True))
    out: list[tuple[int, int]] = []
    last, times = -1, 0
    for x in merge(*lists):
        if x == last:
            times += 1
            continue
        if times:
            out.append((last, times))
        last, times = x, 1
    if times:
        out.append((last, times))
    return out


def search_cell(ids: list[int], sets: list[np.ndarray], left: list[bool], right: list[bool], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Star edges (doc_id, smallest doc_id) of the sets that links between a left and a right set
    connect. ``ids`` ascend."""
    rights = [k for k, r in enumerate(right) if r]
    value = np.concatenate([sets[k] for k in rights]) if rights else np.zeros(0, np.uint64)
    if not len(value) or not any(left):
        return []
    who = np.repeat(np.array(rights), [len(sets[k]) for k in rights])
    order = np.argsort(value, kind="stable")  # owners ascend in every list
    value, owners = value[order], who[order].tolist()
    keys, first = np.unique(value, return_index=True)
    first = np.append(first, len(value))
    size = [len(s) for s in sets]
    forest = _Forest(len(sets))
    for q in range(len(sets)):
        if not left[q]:
            continue
        n = size[q]
        need = -(-percent * n // 100)
        at = np.minimum(np.searchsorted(keys, sets[q]), len(keys) - 1)
        at = at[keys[at] == sets[q]]
        if len(at) < need:
            continue
        lists = sorted(((int(first[k]), int(first[k + 1])) for k in at), key=lambda x: x[0] - x[1])
        longest = lists[0][1] - lists[0][0]
        aside = min(need - 1, int(need / (MU * log2(max(longest, 2)) + 1)))
        found = [f for f in _merged([owners[a:b] for a, b in lists[aside:]]) if f[1] >= need - aside]
        root = forest.find(q)
        for x, times in found:
            low, high = (n, size[x]) if n < size[x] else (size[x], n)
            if x == q or 100 * low < percent * high or forest.find(x) == root:
                continue
            for k, (a, b) in enumerate(lists[:aside]):
                i = bisect_left(owners, x, a, b)
                times += i < b and owners[i] == x
                if times + aside - 1 - k < need:
                    break
            if 100 * times >= percent * (n + size[x] - times):
                forest.join(q, x)
                root = forest.find(q)
    return [(ids[k], ids[forest.find(k)]) for k in range(len(ids)) if forest.find(k) != k]


def _cell_edges(cells: DataFrame, percent: int) -> DataFrame:
    """Search every cell; the rows of a cell are neighbours in their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets, chunk = None, [], [], []

        def done() -> pa.RecordBatch:
            i, j = key[1], key[2]
            edges = search_cell(ids, sets, [c == i for c in chunk], [c == j for c in chunk], percent)
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], names=["u", "v"])

        for batch in batches:
            fam, i, j, c, d, s = (batch.column(x).to_pylist() for x in ("family", "i", "j", "chunk", "doc_id", "shingles"))
            for now in zip(fam, i, j, d, c, s, strict=True):
                if now[:3] != key:
                    if key is not None:
                        yield done()
                    key, ids, sets, chunk = now[:3], [], [], []
                if ids and ids[-1] == now[3] and len(sets[-1]) * 8 == len(now[5]) and sets[-1].tobytes() == now[5]:
                    continue  # a repeated row
                ids.append(now[3])
                sets.append(np.frombuffer(now[5], dtype=np.uint64))
                chunk.append(now[4])
        if key is not None:
            yield done()

    return (cells.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "doc_id")
            .select("family", "i", "j", "chunk", "doc_id", "shingles").mapInArrow(run, "u long, v long"))


def linkable(base: DataFrame, percent: int) -> DataFrame:
    """(doc_id, digest) of the classes of the profiles whose set may link with another, those with few enough sampled
    shingles of their own; doc_id is the class's smallest. A class whose rows lie in several tasks emits its
    sample in each and counts once. The first and last rows of a task count as shared, as their neighbours are elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), np.int64)  # the last two rows, whose right neighbours aren't known yet
        for batch in batches:
            now = np.concatenate([held, np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "class")])], axis=1)
            if not now.shape[1]:
                continue
            now = now[:, np.concatenate([[True], (now[:, 1:] != now[:, :-1]).any(axis=0)])]
            sig, name = now
            if len(sig) > 2:
                alone = (sig[1:-1] != sig[:-2]) & (sig[1:-1] != sig[2:])
                ids, n = np.unique(name[1:-1][alone], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["class", "own"])
            held = now[:, -2:]

    name = F.xxhash64("digest").alias("class")
    rows = base.select(F.explode("sample").alias("sig"), name)
    own = rows.repartitionByRange("sig", "class").sortWithinPartitions("sig", "class").mapInArrow(run, "class long, own long").groupBy("class").agg(F.sum("own").alias("own"))
    asked = (base.filter((F.col("n_shingles") >= least_size(percent)) & F.col("doc_id").isNotNull())
             .groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")).select("*", name).join(own, "class", "left"))
    return written(asked.filter(100 * F.coalesce("own", F.lit(0)) <= (100 - percent) * F.col("n")).select("doc_id", "digest"), "linkable")


def signature_ties(sigs: DataFrame) -> DataFrame:
    """(u, v): ties of ids that connect all ids (``doc_id``) of each ``sig``."""
    names = ["kind", "part", "sig", "u", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, last = TaskContext.get().partitionId(), None, None

        def rows(kind: int, sig: int, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(np.full(len(u), x, np.int64)) for x in (kind, part, sig)), pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=names)

        def pairs() -> Iterator[pa.RecordBatch]:
            nonlocal head, last
            for batch in batches:
                sig, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "doc_id"))
                if not len(sig):
                    continue
                head = head or (int(sig[0]), int(doc[0]))
                now = last or (*head, head[1])  # signature, its first id here, the last id
                new = np.concatenate([[int(sig[0]) != now[0]], sig[1:] != sig[:-1]])
                at = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
                first = np.where(at < 0, now[1], doc[at])
                last = int(sig[-1]), int(first[-1]), int(doc[-1])
                tied = np.unique(np.stack([doc, first], axis=1)[doc != first], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(tied[:, 0]), pa.array(tied[:, 1])], names=["u", "v"])

        for star in contract(pairs()):
            far = star.filter(pc.not_equal(star.column(0), star.column(1)))
            yield rows(2, 0, *(far.column(k).to_numpy() for k in (0, 1)))
        if last is not None:
            yield rows(0, head[0], *[np.array([head[1]])] * 2)
            yield rows(1, last[0], *[np.array([last[2]])] * 2)

    ranged = sigs.select("sig", "doc_id").repartitionByRange("sig", "doc_id").sortWithinPartitions("sig", "doc_id")
    found = written(ranged.mapInArrow(run, ", ".join(f"{n} long" for n in names)), "ties")
    ends: dict[int, dict[int, tuple[int, int]]] = {}  # two rows a task
    for r in found.filter("kind < 2").collect():
        ends.setdefault(r["part"], {})[r["kind"]] = r["sig"], r["u"]
    order = [ends[p] for p in sorted(ends)]
    across = [(b[0][1], a[1][1]) for a, b in zip(order, order[1:]) if a[1][0] == b[0][0] and a[1][1] != b[0][1]]
    ties = found.filter("kind = 2").select("u", "v")
    return ties.unionByName(ties.sparkSession.createDataFrame(across, "u long, v long")) if across else ties


#: Tokens that a batch of ``_tokens`` has at most, unless one set has more. What counts as the frequency of a
#: shingle whose rows may lie in several tasks.
TOKENS, MANY = 1 << 17, 1 << 40


def _tokens(rows: DataFrame) -> DataFrame:
    """(family, sig, doc_id): the shingles of (family, doc_id, shingles), one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs, bounds = _flat(batch.column("shingles"))
            for a, b in tv.slices(bounds, TOKENS):
                n = np.diff(bounds[a:b + 1])
                family, doc = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False)[a:b], n) for c in ("family", "doc_id"))
                yield pa.RecordBatch.from_arrays([pa.array(family), pa.array(sigs[bounds[a]:bounds[b]].view(np.int64)), pa.array(doc)], names=["family", "sig", "doc_id"])

    return rows.mapInArrow(run, "family long, sig long, doc_id long")


def _frequencies(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``often``: how many sets of the family have the shingle. A task's first and last shingles
    have rows elsewhere, too, perhaps, and are MANY, in all tasks that have them: so ``often`` goes by the shingle."""
    names = ["family", "sig", "doc_id", "often"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, run_on = False, []  # run_on: the rows of the shingle that isn't over

        def counted(rows: np.ndarray, starts: np.ndarray, ends: bool) -> pa.RecordBatch:
            nonlocal begun
            n = np.diff(np.append(starts, rows.shape[1]))
            often = np.where(np.arange(len(n)) < (not begun), MANY, MANY if ends else n)
            begun = True
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows, np.repeat(often, n))], names=names)

        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names[:3]])
            if not now.shape[1]:
                continue
            if run_on and (now[:2, -1] == run_on[0][:2, 0]).all():
                run_on.append(now)
                continue
            now = np.concatenate([*run_on, now], axis=1)
            now = now[:, np.concatenate([[True], (now[:, 1:] != now[:, :-1]).any(axis=0)])]  # without repeated rows
            starts = np.flatnonzero(np.concatenate([[True], (now[:2, 1:] != now[:2, :-1]).any(axis=0)]))
            if len(starts) > 1:
                yield counted(now[:, :starts[-1]], starts[:-1], False)
            run_on = [now[:, starts[-1]:]]
        if run_on:
            now = np.concatenate(run_on, axis=1)
            now = now[:, np.concatenate([[True], now[2, 1:] != now[2, :-1]])]
            yield counted(now, np.zeros(1, np.int64), True)

    return tokens.repartitionByRange("family", "sig", "doc_id").sortWithinPartitions("family", "sig", "doc_id").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _rare_first(counted: DataFrame, percent: int) -> DataFrame:
    """(sig, doc_id): linked sets of a family share a ``sig``, made of a level that both are in or next to and
    of one of either's first shingles in the order of their frequencies."""
    ends = levels(percent)

    def of_whole(rows: np.ndarray) -> pa.RecordBatch:
        doc, often, sig, family = rows
        starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        n = np.diff(np.append(starts, len(doc)))
        first = _ramp(n) < np.repeat(n + percent * -n // 100 + 1, n)  # percent * -n // 100: -ceil(percent * n / 100)
        use = np.flatnonzero(first & (often > 1))
        token = tv.mix(tv.mix(family[use].view(np.uint64)) ^ sig[use].view(np.uint64))
        level = np.repeat(np.searchsorted(ends, n, side="right"), n)[use].astype(np.uint64)
        value = np.concatenate([tv.mix(token + level), tv.mix(token + level - np.uint64(1))]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(value), pa.array(np.tile(doc[use], 2))], names=["sig", "doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_on: list[np.ndarray] = []  # the rows of the set that isn't over
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "often", "sig", "family")])
            if not now.shape[1]:
                continue
            if run_on and now[0, -1] == run_on[0][0, 0]:
                run_on.append(now)
                continue
            now = np.concatenate([*run_on, now], axis=1)
            last = int(np.searchsorted(now[0], now[0, -1]))
            if last:
                yield of_whole(now[:, :last])
            run_on = [now[:, last:]]
        if run_on:
            yield of_whole(np.concatenate(run_on, axis=1))

    return counted.repartition("doc_id").sortWithinPartitions("doc_id", "often", "sig").select("doc_id", "often", "sig", "family").mapInArrow(run, "sig long, doc_id long")


def parted(family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The families (node, component) of (doc_id, shingles), parted where none of a part's sets links with one of
    another part. Chance ties, of a common line or passage, grow with the square of the sets and make one family of
    most; by frequency order, such a line is among the first shingles of those sets alone that have little else in
    common with others."""
    rows = (family.select("node", F.col("component").alias("family")).join(sets.hint("merge"), F.col("node") == F.col("doc_id"))
            .select("family", "doc_id", "shingles"))
    first, at = written_at(_rare_first(_frequencies(_tokens(rows)), percent), "rare-first")
    release(family.sparkSession)
    heads = first.groupBy("sig").agg(F.min("doc_id").alias("v"))
    parts = components(first.join(heads, "sig").select(F.col("doc_id").alias("u"), "v"))
    dropped(family.sparkSession, at)
    return written(parts, "families")


def link_families(ties: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, cell: int, sets: DataFrame | None = None) -> DataFrame:
    """(node, component) by the links within the families that the ``ties`` (u, v) of nodes make.
    ``sets_of`` gives (doc_id, family, chunk, chunks, shingles) for (node, family, chunk, chunks), doc_id
    being the node. With ``sets`` (doc_id, shingles) of all nodes, the families are parted first."""
    family = written(components(ties), "families")
    if sets is not None:
        family = parted(family, sets, percent)
        release(family.sparkSession)
    width = family.groupBy("component").agg(F.ceil(F.count("*") / F.lit(cell)).cast("int").alias("chunks"))
    nodes = (family.join(width, "component")
             .select("node", F.col("component").alias("family"), "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = (sets_of(nodes).select("*", other.alias("other"))
             .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))
    return components(_cell_edges(cells, percent))


def _linked(texts: DataFrame, base: DataFrame, at: str, classes: DataFrame, words: int, percent: int, cell: int) -> DataFrame:
    """(node, component) of the classes' smallest ids, by the signatures of the profiles ``base``, which are deleted."""
    ties = signature_ties(base.select("doc_id", F.explode("sigs").alias("sig"))).select(F.col("u").alias("doc_id"), F.col("v").alias("head")).distinct()
    dropped(texts.sparkSession, at)  # the signatures are the largest table of all
    name = classes.filter("rep is not null").select(F.col("doc_id").alias("id"), "rep").distinct()
    ties = (ties.join(name.withColumnRenamed("rep", "u"), F.col("doc_id") == F.col("id")).drop("id")
            .join(name.withColumnRenamed("rep", "v"), F.col("head") == F.col("id")).select("u", "v"))
    place = classes.filter("doc_id = rep").select(F.col("rep").alias("node"), F.col("doc_id"), "digest").distinct()
    return link_families(ties, lambda nodes: _sets(texts.join(nodes.join(place, "node"), "doc_id").select("doc_id", "text", "digest", "family", "chunk", "chunks"), words), percent, cell)


def _linked_pruned(texts: DataFrame, base: DataFrame, at: str, classes: DataFrame, words: int, percent: int, cell: int) -> DataFrame:
    """``_linked`` of the sets that may link at all. These are written once; of the profiles only samples are used. Texts
    of one id are the same. Shuffles of each part are deleted before the next. What the texts and sets are joined
    with grows with them and is never broadcast."""
    spark = texts.sparkSession
    asked = linkable(base, percent)
    dropped(spark, at)
    release(spark)
    sets, sets_at = written_at(_sets(texts.join(asked.hint("merge"), "doc_id"), words), "sets")
    signed, signed_at = written_at(_signed(sets, percent), "signed")
    release(spark)
    ties = signature_ties(signed.select("doc_id", F.explode("sigs").alias("sig"))).distinct()
    dropped(spark, signed_at)
    release(spark)
    linked = link_families(ties, lambda nodes: nodes.join(sets.hint("merge"), F.col("node") == F.col("doc_id")).select("doc_id", "family", "chunk", "chunks", "shingles"), percent, cell, sets)
    dropped(spark, sets_at)
    return linked


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, cell: int = CELL, prune: bool = False) -> DataFrame:
    """doc_id, n_words, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    base, at = written_at(_profiles(docs, words, percent, prune), "profiles")
    slim = base.select("doc_id", "n_words", "n_shingles", "digest")
    # Written first, so that both sides of the join are plain exchanges and Spark may split a digest
    # that a large part of the rows has.
    reps = written(slim.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")), "reps")
    classes = written(slim.join(reps, "digest", "left"), "classes")

    # Families: classes that share a signature.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    linked = (_linked_pruned if prune else _linked)(texts, base, at, classes, words, percent, cell)
    return (classes.join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select("doc_id", "n_words", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")))


def _own_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__own``: a number for each (doc_id, text), ascending by doc_id, then by hash of the text.
    Null where doc_id is. Rows are numbered by their place in sorted partitions, so none gathers them."""
    pairs = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__hash")).filter("__id is not null").distinct()
    ranged = pairs.repartitionByRange("__id", "__hash").sortWithinPartitions("__id", "__hash")
    own = written(ranged.withColumn("__own", F.monotonically_increasing_id()), "own-ids")
    return docs.join(own, (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left").drop("__id", "__hash")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, all columns kept.
    Repeated rows (one id, one text) leave one row; rows without an id stay. Where rows share an id but
    not a text, each is a document of its own, the smaller hash of its text first."""
    names = docs.columns
    ids = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash")).filter("id is not null")
    key = F.col("doc_id").cast("long")
    often = written(ids.groupBy("id").agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high")).filter("n > 1"), "often")
    if not often.filter("low < high").isEmpty():
        docs, key = written(_own_ids(docs), "own"), F.col("__own")
    gone = (jaccard_components(docs.select(key.alias("doc_id"), "text"), **options).groupBy("doc_id").agg(F.min(F.col("component_id") == F.col("doc_id")).alias("first"))
            .filter(~F.col("first")).select(F.col("doc_id").alias("__gone")))
    gone = written(gone, "gone")
    release(docs.sparkSession)
    left = docs.join(gone, key == F.col("__gone"), "left_anti")
    kept = [F.col(f"`{c}`") for c in names]
    if often.isEmpty():
        return left.select(*kept)
    # Only rows whose id occurs again are dealt anew, by an aggregation that makes repeated rows one in each task.
    again, on = often.select(F.col("id").alias("__often")), F.col("doc_id").cast("long") == F.col("__often")
    repeated = left.join(again, on, "left_semi").withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"])
    return left.join(again, on, "left_anti").select(*kept).unionByName(repeated.select(*kept))
