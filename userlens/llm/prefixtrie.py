"""Conversation prefix trie by composable monoid fingerprints.

A conversation c is rebuilt from the first h turns of another one, its base, and its own turns after the first h
(``bases``). Every distinct prefix of rebuilt turns is a node. Rebuilt texts are never made: a run of turns has
a fingerprint (turns, words, two polynomial hashes), fingerprints of runs multiply to that of the runs end to
end, and a rebuilt prefix is the product of the base's head and the own turns' suffix, in numbers alone.

1. A turn is stored under a 128-bit reference, a hash of role and text. One distinct over (role, text) proves that
   no two stored turns share a reference, so references are compared in place of texts from here on.
2. Turns are sorted by range, a hot conversation over many tasks; each task multiplies up the turns of its part of
   a conversation. Parts (as many as tasks, at most) are multiplied up per conversation. Then each own turn's
   prefix is (base head - own head) * B^k + own prefix, by its part's constants.
3. Nodes are the groups of equal (depth, fingerprint). A group is verified by its members' last turns: their stored
   references must be one. As equal fingerprints with one last turn have equal parents' fingerprints, all
   groups' checks together prove every group. Where a check fails, all is done anew with the next hash.
4. Subtree figures come without walks up the trie. A conversation owns the nodes whose smallest member it is; these
   are the last ones of its path, so a node's subtree holds its members' last parts. With S the words of c's
   path before its own nodes, saved_tokens is the sum of S - (words before the node) over members that don't own
   the node, and n_leaves counts the members that own a leaf. Only nodes of two or more members need it.
5. A node's members that end there are sorted by range and joined to texts of at most ``CHUNK`` bytes, which one
   task hashes in turn, as SHA-256 goes; it holds one such text at a time.

Order is by ``turn``, nulls first, then role, the first ``HEAD`` characters of role and text, and a hash of both, so
ties have a defined order; equal rows are turns each. Defined results: a null role or text is empty; rows with a
null conv_id belong to no conversation and are left out; ``c % 20`` has the sign of c; an empty table has no
conversation, so not even the root, and gives an empty table; other columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import written

GROUP, MOST_HEAD = 20, 3
HEAD = 64
CHUNK = 1 << 16
#: Rows of one conversation that are joined to its figures under one key.
BLOCK = 512


class Print(NamedTuple):
    """Fingerprint of a run of turns; the empty run's is all zeros."""

    turns: int
    words: int
    a: int
    b: int


EMPTY = Print(0, 0, 0, 0)


class Hash(NamedTuple):
    """Two polynomial hashes, to the base ``base`` modulo the primes ``p`` and ``q``, of turns' references under ``seed``."""

    seed: int = 0
    p: int = (1 << 61) - 1
    q: int = (1 << 61) - 31
    base: int = 0x1B873593CC9E2D51 % ((1 << 61) - 31)

    def reference(self, role: str, text: str) -> tuple[int, int]:
        r = role.encode()
        d = hashlib.blake2b(b"%d:" % len(r) + r + text.encode(), digest_size=16, key=b"%d" % self.seed).digest()
        return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)

    def turn(self, ref: tuple[int, int], words: int) -> Print:
        return Print(1, words, ref[0] % self.p, ref[1] % self.q)

    def product(self, x: Print, y: Print) -> Print:
        return Print(x.turns + y.turns, x.words + y.words,
                     (x.a * pow(self.base, y.turns, self.p) + y.a) % self.p, (x.b * pow(self.base, y.turns, self.q) + y.b) % self.q)

    def before(self, x: Print, last: Print) -> Print:
        """The run that ``last``, its last turn, was added to."""
        return Print(x.turns - 1, x.words - last.words, (x.a - last.a) * pow(self.base, -1, self.p) % self.p, (x.b - last.b) * pow(self.base, -1, self.q) % self.q)

    def replaced(self, x: Print, head: Print, other: Print) -> Print:
        """``x`` with ``other`` in place of ``head``, the run that it begins with."""
        k = x.turns - head.turns
        return Print(k + other.turns, x.words - head.words + other.words,
                     (x.a + (other.a - head.a) * pow(self.base, k, self.p)) % self.p, (x.b + (other.b - head.b) * pow(self.base, k, self.q)) % self.q)


#: The hashes that are tried in turn.
HASHES = tuple(Hash(seed, base=(0x1B873593CC9E2D51 + 0x9E3779B97F4A7C15 * seed) % ((1 << 61) - 31)) for seed in range(4))

Rows = Iterator[pa.RecordBatch]


def bases(conv: Column) -> tuple[Column, Column]:
    """(base conversation, turns taken from it) of a conversation."""
    return conv - conv % GROUP, F.crc32(conv.cast("string")) % (MOST_HEAD + 1)


def _batch(names: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of longs under ``names``; a name with ``?`` is a boolean."""
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names.split())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n.endswith("?") else pa.int64()) for c, n in zip(cols, names.split(), strict=True)], names=[n.rstrip("?") for n in names.split()])


def _schema(names: str) -> str:
    return ", ".join(f"{n.rstrip('?')} {'boolean' if n.endswith('?') else 'long'}" for n in names.split())


def _tuples(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names or batch.schema.names), strict=True)


def _made(df: DataFrame, names: str, of: Callable[[tuple], list[tuple]]) -> DataFrame:
    """The rows that ``of`` makes of each row."""
    def run(batches: Rows) -> Rows:
        for batch in batches:
            yield _batch(names, [x for row in _tuples(batch) for x in of(row)])

    return df.mapInArrow(run, _schema(names))


# ---- turns -----------------------------------------------------------------------------------------

def _plain(conversations: DataFrame) -> DataFrame:
    return (conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .filter("conv is not null"))


def _store_is_sound(plain: DataFrame, hashing: Hash) -> bool:
    """No two different turns have one reference."""
    def run(batches: Rows) -> Rows:
        for batch in batches:
            yield _batch("r1 r2", [hashing.reference(role, text) for role, text in _tuples(batch)])

    refs = plain.select("role", "text").distinct().mapInArrow(run, "r1 long, r2 long")
    return refs.groupBy("r1", "r2").count().filter("count > 1").isEmpty()


def _turns(plain: DataFrame, hashing: Hash) -> DataFrame:
    """conv, part (the task that sorted it), nth (in that part of the conversation, from 1), the product up to it (w, a,
    b) and its own reference and words."""
    def refer(batches: Rows) -> Rows:
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column("text"))
            words = [n for a, b in tv.slices(offsets) for n in tv.words_of(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]).counts.tolist()]
            refs = _batch("r1 r2 words", [(*hashing.reference(*rt), n) for rt, n in zip(_tuples(batch, "role", "text"), words, strict=True)])
            kept = [batch.column(c) for c in ("conv", "turn", "r", "t", "h", "row")]
            yield pa.RecordBatch.from_arrays([*kept, *refs.columns], names=["conv", "turn", "r", "t", "h", "row", "r1", "r2", "words"])

    known = plain.select("*", F.substring("role", 1, HEAD).alias("r"), F.substring("text", 1, HEAD).alias("t"), F.xxhash64("role", "text").alias("h"),
                         F.monotonically_increasing_id().alias("row")).mapInArrow(
        refer, "conv long, turn long, r string, t string, h long, row long, r1 long, r2 long, words long")
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "r", "t", "h", "row")]
    names = "conv part nth w a b r1 r2 words"

    def multiply(batches: Rows) -> Rows:
        part, conv, now = TaskContext.get().partitionId(), None, EMPTY
        for batch in batches:
            out = []
            for c, r1, r2, words in _tuples(batch, "conv", "r1", "r2", "words"):
                if c != conv:
                    conv, now = c, EMPTY
                now = hashing.product(now, hashing.turn((r1, r2), words))
                out.append((c, part, *now, r1, r2, words))
            yield _batch(names, out)

    return known.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "r1", "r2", "words").mapInArrow(multiply, _schema(names))


def _parts(turns: DataFrame, hashing: Hash) -> DataFrame:
    """conv, part, the product before the part (n0 w0 a0 b0), and the conversation's turns and words."""
    last = turns.groupBy("conv", "part").agg(F.max(F.struct("nth", "w", "a", "b")).alias("x"))
    lists = last.groupBy("conv").agg(F.collect_list(F.struct("part", "x.nth", "x.w", "x.a", "x.b")).alias("parts"))

    def of(row: tuple) -> list[tuple]:
        conv, parts = row
        now, out = EMPTY, []
        for p in sorted(parts, key=lambda p: p["part"]):
            out.append((conv, p["part"], *now))
            now = hashing.product(now, Print(p["nth"], p["w"], p["a"], p["b"]))
        return [(*x, now.turns, now.words) for x in out]

    return _made(lists, "conv part n0 w0 a0 b0 n_turns n_words", of)


# ---- rebuilt prefixes ------------------------------------------------------------------------------

def _heads(turns: DataFrame, parts: DataFrame, hashing: Hash) -> DataFrame:
    """conv and ``head``: its first ``MOST_HEAD`` turns, (place, w, a, b, r1, r2, words) each."""
    def of(row: tuple) -> list[tuple]:
        conv, nth, w, a, b, r1, r2, words, *before = row
        x = hashing.product(Print(*before), Print(nth, w, a, b))
        return [(conv, *x, r1, r2, words)] if x.turns <= MOST_HEAD else []

    first = turns.filter(F.col("nth") <= MOST_HEAD).join(parts.select("conv", "part", "n0", "w0", "a0", "b0"), ["conv", "part"])
    rows = _made(first.select("conv", "nth", "w", "a", "b", "r1", "r2", "words", "n0", "w0", "a0", "b0"), "conv place w a b r1 r2 words", of)
    return rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("place", "w", "a", "b", "r1", "r2", "words"))).alias("head"))


def _rebuilt(parts: DataFrame, heads: DataFrame) -> DataFrame:
    """conv, h, ``own`` head (of h turns at most), ``base`` head (the same), depth and words of the rebuilt conversation."""
    base, h = bases(F.col("conv"))
    convs = parts.groupBy("conv").agg(F.max("n_turns").alias("n_turns"), F.max("n_words").alias("n_words")).select("*", base.alias("b"), h.alias("h"))
    mine = heads.select("conv", F.col("head").alias("own"))
    theirs = heads.select(F.col("conv").alias("b"), F.col("head").alias("base"))
    joined = convs.join(mine, "conv").join(theirs, "b", "left")
    cut = lambda c: F.slice(F.coalesce(F.col(c), F.array().cast(mine.schema["own"].dataType)), F.lit(1), F.col("h").cast("int"))
    words = lambda c: F.coalesce(F.try_element_at(c, F.lit(-1))["w"], F.lit(0))
    out = joined.select("conv", "h", "n_turns", "n_words", cut("own").alias("own"), cut("base").alias("base"))
    return out.select("conv", "h", "own", "base", (F.size("base") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).cast("long").alias("depth"),
                      (F.col("n_words") - words(F.col("own")) + words(F.col("base"))).alias("total"))


#: A prefix: conversation, depth, words, hashes, hashes of the prefix before, last turn's reference and words, whether
#: the rebuilt conversation ends here.
PREFIX = "conv d w a b pa pb r1 r2 words ends?"


def _prefixes(turns: DataFrame, parts: DataFrame, rebuilt: DataFrame, hashing: Hash) -> DataFrame:
    def row_of(conv: int, x: Print, r1: int, r2: int, words: int, depth: int) -> tuple:
        up = hashing.before(x, hashing.turn((r1, r2), words))
        return (conv, *x, up.a, up.b, r1, r2, words, x.turns == depth)

    def head(row: tuple) -> list[tuple]:
        conv, base, depth = row
        return [(conv, *EMPTY, 0, 0, 0, 0, 0, depth == 0),
                *(row_of(conv, Print(t["place"], t["w"], t["a"], t["b"]), t["r1"], t["r2"], t["words"], depth) for t in base)]

    def own(row: tuple) -> list[tuple]:
        conv, nth, w, a, b, r1, r2, words, n0, w0, a0, b0, h, hw, ha, hb, n, bw, ba, bb, depth = row
        if n0 + nth <= h:
            return []
        x = hashing.product(Print(n0, w0, a0, b0), Print(nth, w, a, b))
        return [row_of(conv, hashing.replaced(x, Print(h, hw, ha, hb), Print(n, bw, ba, bb)), r1, r2, words, depth)]

    end = lambda c, f: F.coalesce(F.try_element_at(c, F.lit(-1))[f], F.lit(0))
    figures = rebuilt.select("conv", "h", *[end("own", f).alias(f"h{f}") for f in "wab"], F.size("base").cast("long").alias("n"), *[end("base", f).alias(f"b{f}") for f in "wab"], "depth")
    constants = parts.drop("n_turns", "n_words").join(figures, "conv")
    mine = turns.join(constants, ["conv", "part"]).select("conv", "nth", "w", "a", "b", "r1", "r2", "words", "n0", "w0", "a0", "b0", "h", "hw", "ha", "hb", "n", "bw", "ba", "bb", "depth")
    return _made(rebuilt.select("conv", "base", "depth"), PREFIX, head).unionByName(_made(mine, PREFIX, own))


# ---- nodes -----------------------------------------------------------------------------------------

KEY = ["d", "a", "b"]


def _ends(prefixes: DataFrame) -> DataFrame:
    """d, a, b, ends_sha256 of the nodes where conversations end."""
    def texts(batches: Rows) -> Rows:
        node, first, ids, size = None, 0, [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in (*node, first)), pa.array([",".join(ids)])], names=[*KEY, "first", "ids"])

        for batch in batches:
            for d, a, b, conv in _tuples(batch):
                if (d, a, b) != node or size >= CHUNK:
                    if node is not None:
                        yield done()
                    node, first, ids, size = (d, a, b), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if node is not None:
            yield done()

    def hashes(batches: Rows) -> Rows:
        node, sha = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in node), pa.array([sha.hexdigest()])], names=[*KEY, "ends_sha256"])

        for batch in batches:
            for d, a, b, _, ids in _tuples(batch):
                if (d, a, b) != node:
                    if node is not None:
                        yield done()
                    node, sha = (d, a, b), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if node is not None:
            yield done()

    order = [*KEY, "conv"]
    ranged = prefixes.filter("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = ranged.mapInArrow(texts, "d long, a long, b long, first long, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashes, "d long, a long, b long, ends_sha256 string")


def _subtrees(prefixes: DataFrame, rebuilt: DataFrame, nodes: DataFrame) -> DataFrame:
    """d, a, b, n_leaves and saved of the nodes of two or more members."""
    owned = nodes.groupBy("conv_id").agg(F.min("d").alias("since"), F.sum("words").alias("mine"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
                                         F.max(F.when(F.col("n_convs") > 1, F.col("d"))).alias("shared"))
    far = F.lit((1 << 62))
    per = (rebuilt.select("conv", "depth", "total").join(owned.withColumnRenamed("conv_id", "conv"), "conv", "left")
           .select("conv", F.coalesce("since", far).alias("since"), (F.col("total") - F.coalesce("mine", F.lit(0))).alias("s"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
                   F.coalesce(F.greatest(F.col("since") - 1, "shared"), F.col("depth")).alias("upto")).filter("upto >= 0"))
    blocks = per.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("upto") / BLOCK))))
    rows = prefixes.select("conv", *KEY, (F.col("w") - F.col("words")).alias("above"), F.floor(F.col("d") / BLOCK).alias("block")).join(blocks, ["conv", "block"]).filter("d <= upto")
    return rows.groupBy(*KEY).agg(F.sum("leaf").alias("n_leaves"), F.coalesce(F.sum(F.when(F.col("d") < F.col("since"), F.col("s") - F.col("above"))), F.lit(0)).alias("saved"))


def trie(conversations: DataFrame, hashes: tuple[Hash, ...] = HASHES) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    plain = _plain(conversations)
    for hashing in hashes:
        if not _store_is_sound(plain, hashing):
            continue
        turns = written(_turns(plain, hashing), "turns")
        parts = written(_parts(turns, hashing), "parts")
        rebuilt = written(_rebuilt(parts, _heads(turns, parts, hashing)), "rebuilt")
        prefixes = written(_prefixes(turns, parts, rebuilt, hashing), "prefixes")
        groups = written(prefixes.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
            (F.min("r1") == F.max("r1")).alias("same1"), (F.min("r2") == F.max("r2")).alias("same2")), "groups")
        if groups.filter("not (same1 and same2)").isEmpty():
            break
    else:
        raise RuntimeError("every hash had different turns with equal fingerprints")
    children = groups.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = written(groups.drop("same1", "same2").join(children, KEY, "left").fillna({"n_children": 0}), "nodes")
    above = groups.select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    found = (nodes.join(above.filter("d > 0"), ["d", "pa", "pb"], "left")
             .select(*KEY, "conv_id", F.when(F.col("d") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children")
             .join(_subtrees(prefixes, rebuilt, nodes), KEY, "left").join(_ends(prefixes), KEY, "left"))
    return found.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
                        F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
