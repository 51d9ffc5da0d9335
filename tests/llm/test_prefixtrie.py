"""The trie against a plain one, the monoid's laws, forced collisions, and edge rows."""

import hashlib
import random
import re
import zlib

import pytest

from userlens.llm import prefixtrie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes by walking every rebuilt conversation turn by turn."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], set()).add(c)
        ends.setdefault(whole, []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves.setdefault(node, 0)
        if node not in kids:
            leaves[node] = 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * words
        if node:
            up = node[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), kids.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def frame(spark):
    from userlens.llm.shared import ship

    ship(spark)
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def made(seed, convs=60, turns=7, texts=3):
    """Conversations over few texts, so that many prefixes are shared."""
    r = random.Random(seed)
    rows = [(c, k, r.choice(["user", "assistant"]), " ".join(["say"] * (1 + r.randrange(texts)))) for c in r.sample(range(-30, 300), convs) for k in range(r.randrange(1, turns))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_a_plain_one(frame, seed):
    rows = made(seed)
    assert found(pt.trie(frame(rows).repartition(5))) == brute(rows)


def test_given_table(spark, frame):
    import os

    at = "/root/testdata/sf0.01/conversations.parquet"
    if not os.path.isfile(at):
        pytest.skip("driver test data not present")
    df = spark.read.parquet(at)
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(pt.trie(df)) == brute(rows)


def test_edge_rows(spark, frame):
    from pyspark.sql import functions as F

    long = "word " * 100_000
    rows = [(0, 1, "user", "hi"), (0, None, "system", "be kind"), (0, None, None, None), (0, 2, "user", ""), (20, 5, "user", "hi"),
            (7, 1, "user", "hi"), (7, 1, "user", "hi"), (7, 1, "assistant", long), (None, 1, "user", "lost"), (None, None, None, None),
            (41, 1, "user", "orphan"), (42, 1, None, "orphan"), (43, 1, "", "orphan"), (44, -5, "a b", "c"), (45, -5, "a", "b c"),
            (-3, 1, "user", "hi"), (2**40, 1, "user", "hi"), (2**40 + 1, 1, "user", long), (2**40 + 2, 1, "user", long + "x")]
    want = brute(rows)
    assert found(pt.trie(frame(rows))) == want
    clash = frame(rows).select("*", *[F.lit("clash").alias(c) for c in ("conv", "part", "nth", "w", "a", "b", "d", "head", "ends", "words", "count", "r", "t", "h", "row")])
    assert found(pt.trie(clash)) == want
    assert pt.trie(frame([])).count() == 0
    assert pt.trie(frame([(None, 1, "user", "x")])).count() == 0
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1)
    assert found(pt.trie(frame([(turnless, 1, "user", "x")]))) == brute([(turnless, 1, "user", "x")])


def test_one_conversation_with_most_rows_and_copies_of_another(frame):
    rows = [(5, k, "user", f"t{k % 7}") for k in range(3000)] + [(c, k, "user", f"same {k}") for c in range(100, 160) for k in range(4)]
    assert found(pt.trie(frame(rows).repartition(6))) == brute(rows)


def test_collisions_are_noticed_and_another_hash_is_taken(frame):
    rows = made(3, convs=25)
    weak = pt.Hash(0, p=3, q=2, base=1)
    assert found(pt.trie(frame(rows), (weak, pt.HASHES[1]))) == brute(rows)
    with pytest.raises(RuntimeError):
        pt.trie(frame(rows), (weak,))


def test_monoid_laws():
    h, r = pt.HASHES[0], random.Random(4)
    runs = [pt.Print(n, r.randrange(50), r.randrange(h.p), r.randrange(h.q)) if n else pt.EMPTY for n in (0, 1, 2, 5, 9)]
    for x in runs:
        assert h.product(x, pt.EMPTY) == x == h.product(pt.EMPTY, x)
        for y in runs:
            for z in runs:
                assert h.product(h.product(x, y), z) == h.product(x, h.product(y, z))
                assert h.replaced(h.product(x, z), x, y) == h.product(y, z)
    last = h.turn((-5, 7), 3)
    for x in runs:
        assert h.before(h.product(x, last), last) == x
