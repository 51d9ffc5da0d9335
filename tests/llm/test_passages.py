"""Passages of short lines, and passages wrapped in two ways."""

import random

from userlens.llm import substring


def test_passages_of_short_lines_and_rewrapped_ones_are_caught(docs_of):
    rng = random.Random(21)
    words = [f"q{k}" for k in range(5000)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    wrap = lambda w, n: "\n".join(" ".join(w[k:k + n]) for k in range(0, len(w), n))
    rows = []
    for k in range(12):
        passage = some(60)
        rows.append((2 * k, "\n".join([wrap(some(40), 8), wrap(passage, 8), wrap(some(40), 8)])))
        rows.append((2 * k + 1, "\n".join([wrap(some(30), 7), wrap(passage, 8 if k < 6 else 5 + k), wrap(some(30), 7)])))
    clean = [(100 + k, wrap(some(120), 8)) for k in range(20)]
    got = substring.repeated_passages(docs_of(rows + clean))
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in rows}
    cut = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs_of(rows + clean), got).collect()}
    for k in range(12):
        assert len(cut[2 * k].split()) == 140 and len(cut[2 * k + 1].split()) <= 120 - 20
    assert all(cut[i] == t for i, t in clean)


def test_a_piece_that_is_a_line_is_found_inside_another_text(docs_of):
    rng = random.Random(22)
    some = lambda n: [f"q{rng.randrange(5000)}" for _ in range(n)]
    passages = [some(60) for _ in range(10)]
    rows = [(k, " ".join(p)) for k, p in enumerate(passages)]
    rows += [(50 + k, "\n".join([" ".join(some(3)), *(" ".join(p[a:a + 6]) for a in range(0, 60, 6))])) for k, p in enumerate(passages)]
    assert {r["doc_id"] for r in substring.repeated_passages(docs_of(rows)).collect()} == {i for i, _ in rows}
