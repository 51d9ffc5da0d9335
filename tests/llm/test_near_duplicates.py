"""The pipeline's near-duplicate stage against a brute force with 5-word shingles at 0.8."""

import itertools
import random

import numpy as np

import corpus_pipeline as cp
from brute import shingles
from userlens.llm import jaccard


def kept(rows, words=5, percent=80):
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            up = [min(up[a], up[b]) if z in (up[a], up[b]) else z for z in up]
    return {rows[k][0] for k in range(len(rows)) if up[k] == k}


def near_copies():
    rng, rows = random.Random(8), []
    word = lambda: f"w{rng.randrange(5000)}"
    for n in (8, 20, 60, 150, 400, 900):
        base = [word() for _ in range(n)]
        for share in (0, 0.01, 0.02, 0.03, 0.04):  # scattered edits
            text = [word() if rng.random() < share else w for w in base]
            rows.append((len(rows), " ".join(text)))
        for part in (0.07, 0.09, 0.15):  # a shared block
            rows.append((len(rows), " ".join([*base[int(n * part):], *(word() for _ in range(int(n * part)))])))
    return rows


def test_stage_keeps_one_of_texts_at_five_words_and_four_fifths(spark, docs_of):
    rows = near_copies()
    want = kept(rows)
    assert want != kept(rows, 3, 90)
    assert {r["doc_id"] for r in cp.near_duplicates(spark, docs_of(rows), "").collect()} == want


def test_linked_sets_share_a_signature_at_four_fifths():
    rng = np.random.default_rng(6)
    for n in [4, 5, 9, 10, 23, 100, 333, 1000, 5000]:
        for _ in range(40):
            most = n // 4
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            gone = rng.integers(0, most + 1)
            b = np.union1d(np.delete(a, rng.choice(len(a), gone, replace=False)), rng.integers(0, 2 ** 63, rng.integers(0, most - gone + 1)).astype(np.uint64))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            value, count = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80)
            assert set(value[:count[0]].tolist()) & set(value[count[0]:].tolist())


def test_unlike_long_sets_share_no_signature():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64)) for n in range(400, 4000, 60)]
    value, count = jaccard.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 80)
    assert len(np.unique(value)) > 0.99 * len(value)


def test_pruning_loses_no_link_among_documents_that_share_passages(docs_of, spark):
    """Near copies, copies and documents that share one passage with all others, at 5 words and 0.8."""
    import random

    from brute import jaccard_components
    from userlens.llm import jaccard
    from userlens.llm.shared import written

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows, i = [], 0
    for _ in range(40):
        base = [word() for _ in range(rng.randrange(20, 300))]
        base[5:5] = passage
        for _ in range(rng.choice([1, 1, 2, 4])):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 40)):
                text[rng.randrange(len(text))] = word()
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i + k, rows[k][1]) for k in range(5)] + [(i + 10, "one two"), (i + 11, "one two"), (i + 12, "")]
    want = jaccard_components(rows, percent=80, words=5)
    assert len({c for _, c in want.values()}) < len(rows)
    docs = docs_of(rows).repartition(4)
    for prune in (False, True):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, words=5, percent=80, prune=prune).collect()}
        assert got == want
    base = written(jaccard._profiles(docs, 5, 80, True), "test-profiles")
    assert jaccard.linkable(base, 80).count() < len(rows) - 5  # sets that only share the passage go


def test_families_tied_by_common_lines_are_parted_and_lose_no_link(docs_of, spark, monkeypatch):
    """Near copies that have common lines: chance ties make them one family, whose cells grow with its square."""
    from brute import jaccard_components

    rng, rows = random.Random(9), []
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    lines = [[word() for _ in range(9)] for _ in range(3)]
    for n in (*[40] * 30, *[60] * 10, *range(30, 300, 30)):
        base = [word() for _ in range(n)]
        for line in lines:
            at = rng.randrange(len(base))
            base[at:at] = line
        for _ in range(2):
            text = list(base)
            text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    base = [word() for _ in range(120)]  # more near copies than a cell has sets
    for _ in range(20):
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = word()
        rows.append((len(rows), " ".join(text)))
    want = jaccard_components(rows, percent=80, words=5)
    search, dealt = jaccard._cell_edges, []

    def seen(cells, percent):
        dealt.append(cells.count())
        return search(cells, percent)

    monkeypatch.setattr(jaccard, "_cell_edges", seen)
    docs = docs_of(rows + rows[::9]).repartition(4)  # some rows twice
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, words=5, percent=80, cell=8, prune=True).collect()}
    assert got == want
    assert 0 < dealt[0] < 3 * len(rows)  # over 900 when most are one family


def test_a_class_with_copies_in_other_tasks_has_shingles_of_its_own(docs_of, spark):
    from userlens.llm.shared import written

    rng = random.Random(10)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(200)) for _ in range(30)]
    rows = spark.sparkContext.parallelize([(100 * c + k, t) for c in range(3) for k, t in enumerate(texts)], 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = written(jaccard._profiles(docs, 5, 80, True), "test-profiles")
    assert jaccard.linkable(base, 80).isEmpty()
