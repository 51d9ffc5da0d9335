"""Pattern packing: plans against the histogram, a round trip against the tokenizer library, edge rows."""

import zlib

import numpy as np
import pytest

from userlens.llm import patternpack as pp
from userlens.llm.queries import tokenizer

BYTE_BPE = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, pp.END_ID]


@pytest.mark.parametrize("name, sizes, most", [
    ("even", np.random.default_rng(1).integers(1, 1024, 20_000), 1.01),
    ("middle", np.random.default_rng(2).integers(200, 500, 20_000), 1.02),
    ("short", np.full(10_000, 3), 1.01),
    ("long", np.full(1_000, 600), 1024 / 600),
    ("full", np.full(50, 1024), 1.0),
    ("few", np.array([1, 1023, 512, 512, 7]), 2.0),
    ("none", np.zeros(0, np.int64), 1.0),
])
def test_plan_uses_each_piece_once_and_wastes_little(name, sizes, most):
    counts = np.bincount(sizes, minlength=pp.ROOM + 1)
    made = pp.plan(counts, pp.ROOM)
    used = np.zeros_like(counts)
    for parts, n in zip(made.patterns, made.repeats, strict=True):
        assert n > 0 and sum(k * m for k, m in parts) <= pp.ROOM
        for k, m in parts:
            used[k] += n * m
    assert (used == counts).all()
    assert made.sequences <= most * -(-int(sizes.sum()) // pp.ROOM) + 1
    greedy = pp.best_fit({int(k): int(counts[k]) for k in np.flatnonzero(counts)}, pp.ROOM)
    assert made.sequences <= greedy.sequences
    if name == "middle":  # where best fit alone wastes room
        assert made.sequences < 0.97 * greedy.sequences


def test_fit_solves_a_histogram_made_of_patterns():
    counts = np.zeros(101, np.int64)
    for parts, n in (([60, 40], 500), ([50, 30, 20], 300), ([33, 33, 34], 200)):
        for k in parts:
            counts[k] += n
    length, times = pp.patterns(counts, 100, 0.0)
    which, x = pp.fit(length, times, counts)
    again = np.zeros(101)
    for p, n in zip(which, x, strict=True):
        np.add.at(again, length[p], times[p] * n)
    assert np.abs(again - counts)[1:].max() < 1e-3 and (x > 0).all()
    assert pp.plan(counts, 100).sequences == 1000


def check(rows, pieces, library, room=pp.ROOM):
    """Pieces rebuild every document, and sequences are gapless and within the limit."""
    want, got = {}, {}
    for i, t in rows:
        want.setdefault(i, []).append(ids_of(library, t))
    for r in pieces:
        got.setdefault(r["doc_id"], []).append(r)
    assert set(want) == set(got)
    for i, docs in want.items():
        ids = docs[0]
        assert all(d == ids for d in docs)
        n = -(-len(ids) // room)
        assert len(got[i]) == n * len(docs)
        for r in got[i]:
            first = len(ids) - (n - 1) * room
            start = 0 if r["piece"] == 0 else first + (r["piece"] - 1) * room
            assert (r["start"], r["length"]) == (start, first if r["piece"] == 0 else room)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[start:start + r["length"]], "<u4").tobytes())
            assert r["doc_tokens"] == len(ids)
    seqs = {}
    for r in pieces:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(seqs)


def test_round_trip_of_the_given_table(spark, real, library):
    docs, rows = real
    pieces = pp.pack(docs, BYTE_BPE).collect()
    n = check(rows, pieces, library)
    total = sum(r["length"] for r in pieces)
    assert n <= 1.05 * -(-total // pp.ROOM)


def test_edge_rows(docs_of, library):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    odd = "it's <|endoftext|> don't 　 中文 👍🏽 \x1c\n\n  x́ ٣٤ " + "a" * 5000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, odd), (7, "same text"), (7, "same text"), (None, "no id")]
    for clash in (False, True):
        pieces = pp.pack(docs_of(rows, clash), BYTE_BPE).collect()
        check(rows, pieces, library)
    assert pp.pack(docs_of([]), BYTE_BPE).count() == 0


def test_many_copies_of_one_length_and_a_small_room(docs_of, library):
    rows = [(i, "the same words again and again") for i in range(700)] + [(1000 + i, "x " * (i % 40)) for i in range(300)]
    pieces = pp.pack(docs_of(rows).repartition(3), BYTE_BPE, room=32).collect()
    check(rows, pieces, library, 32)


def test_units_are_encoded_as_the_library_does(real, library):
    _, rows = real
    encode, _ = pp.encoder(BYTE_BPE)
    units = sorted({" " + w for _, t in rows for w in (t or "").split()} | {"don't", "'ll", "1234567", "!!!...", "<|endoftext|>", "é", "  "})
    assert encode(units) == [e.ids for e in library.encode_batch(units, add_special_tokens=False)]


@pytest.mark.parametrize("size", [1, 3, 40, 700])
def test_bins_of_short_examples_are_full(size):
    """The vector packer of op3: equal examples fill all but a task's last bins."""
    from userlens.llm.packing import PLAIN, Packer

    packer, n = Packer(PLAIN, cut=True), 10_000 // max(1, size // 40)
    out = []
    for a in range(0, n, 500):
        x = np.full(min(500, n - a), size)
        out += packer.add(np.arange(a, a + len(x)), x.copy(), x.copy())
    out += packer.finish()
    used, pieces = {}, {}
    for key, start, length, sequence, offset in out:
        assert used.get(sequence, 0) == offset
        used[sequence] = offset + length
        pieces[key] = pieces.get(key, 0) + length
    assert pieces == dict.fromkeys(range(n), size)
    padded = sum(u if u & (u - 1) == 0 else PLAIN.tokens for u in used.values())
    assert n * size >= 0.95 * padded
