"""Rows that share an id but not a text each follow their own text."""

from userlens.llm import jaccard

A, B, C = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")


def test_a_unique_text_stays_where_its_id_has_a_duplicate_too(docs_of):
    rows = [(3, A), (7, A), (7, B), (7, B), (8, C), (9, C + " d"), (8, C + " e"), (None, A)]
    kept = jaccard.one_of_each(docs_of(rows, True))
    assert kept.columns == docs_of(rows, True).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted((x for x in got if x[0] in (3, 7)), key=str) == [(3, A), (7, B)]
    assert [i for i, _ in got if i in (8, 9)] == [8] and (None, A) in got and len(got) == 4
