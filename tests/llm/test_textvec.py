import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import SPACE_WORD, lower, shingles
from userlens.llm import textvec as tv

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \n\t\x0b.中", max_size=30)), max_size=6)


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.booleans())
def test_words_are_those_of_the_pattern(texts, low):
    raw, offsets = tv.texts_of(pa.array(texts, pa.string()))
    w = tv.words_of(raw, offsets, lower=low)
    got = [[] for _ in texts]
    for d, a, b in zip(w.doc, w.start, w.end, strict=True):
        got[d].append(w.raw[a:b].tobytes().decode())
    assert got == [SPACE_WORD.findall(lower(t) if low else (t or "")) for t in texts]
    assert w.counts.tolist() == [len(g) for g in got]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_sizes_and_overlaps_of_the_real_sets(texts):
    raw, offsets = tv.texts_of(pa.array(texts, pa.string()))
    sets, bounds, _ = tv.shingle_sets(raw, offsets, 3)
    mine = [frozenset(sets[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    real = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(mine[i] & mine[j]) == len(real[i] & real[j])


def test_equal_words_hash_alike_across_blocks(monkeypatch):
    raw, offsets = tv.texts_of(pa.array([("word " * 50) + "x" * 200 + " word"]))
    whole = tv.words_of(raw, offsets).hashes()
    monkeypatch.setattr(tv, "HASH_BYTES", 64)
    w = tv.words_of(raw, offsets)
    parts = tv.span_hashes(raw, w.start, w.end)
    assert len(set(parts[:50].tolist()) | {int(parts[-1])}) == 1
    assert len(np.unique(whole)) == len(np.unique(parts)) == 2


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_slices_cover_all_rows_once(most):
    offsets = np.array([0, 3, 3, 20, 21, 29])
    parts = list(tv.slices(offsets, most))
    assert [x for a, b in parts for x in range(a, b)] == list(range(5))
