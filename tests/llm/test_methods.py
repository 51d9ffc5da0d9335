"""Each operator's method against brute force, held-out data or an exact round trip."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from brute import contamination, jaccard_components, line_counts, secrets as plain_secrets, unigram
from userlens.llm import chat, decontaminate, hmm, jaccard, licenses, packing, quality, secrets, substring, textvec as tv, tokencount
from userlens.llm.queries import QUERIES, tokenizer

WORDS = [f"w{k}" for k in range(400)]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return out


# -- 5


def near_copies(seed, groups=6, each=12):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [rng.choice(WORDS) for _ in range(rng.choice([4, 11, 30, 90, 200]))]
        for _ in range(each):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3])))))
    return rows


@pytest.mark.parametrize("cell", [2, 5, 512])
def test_jaccard_components_lose_no_link(docs_of, cell):
    rows = near_copies(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs_of(rows), cell=cell).collect()}
    assert got == jaccard_components(rows)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for n in [9, 10, 11, 19, 20, 37, 100, 333, 1000]:
        for _ in range(40):
            most = n // 9
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            gone = rng.integers(0, most + 1)
            b = np.union1d(np.delete(a, rng.choice(len(a), gone, replace=False)), rng.integers(0, 2 ** 63, rng.integers(0, most - gone + 1)).astype(np.uint64))
            both = len(np.intersect1d(a, b))
            if 100 * both < 90 * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            value, count = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            assert set(value[:count[0]].tolist()) & set(value[count[0]:].tolist())


def test_search_cell_finds_all_links_of_random_sets():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2 ** 62, 120).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, len(base) - rng.integers(0, 9), replace=False), rng.integers(0, 2 ** 62, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(60)]
    edges = jaccard.search_cell(list(range(60)), sets, [True] * 60, [True] * 60)
    root = {**{k: k for k in range(60)}, **dict(edges)}
    up = list(range(60))
    for a, b in itertools.combinations(range(60), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            x, y = up[a], up[b]
            up = [min(x, y) if z in (x, y) else z for z in up]
    assert [root[k] for k in range(60)] == up


# -- 7, 8, 10 on the given table


def test_decontamination_matches_brute_force(real, spark):
    docs, rows = real
    rng = random.Random(2)
    items = [(k, " ".join(t.split()[a:a + rng.choice([3, 12, 25])])) for k, (_, t) in enumerate(rng.sample(rows, 12)) for a in [rng.randrange(max(1, len(t.split()) - 25))]]
    rows = rows[:60]
    got = {r["doc_id"]: r for r in decontaminate.scan(docs.filter(docs.doc_id < 60), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, t in rows:
        n, hit, found = contamination(t, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hit, found)


def test_base_counts_match_brute_force(real):
    docs, rows = real
    got = {r["doc_id"]: r for r in quality.score_documents(docs, quality.prior()).collect()}
    for i, t in rows:
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == line_counts(t)


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    texts = pa.array(["\n".join(" ".join(rng.choice(["a", "b#", "##", "c."], rng.integers(1, 6))) for _ in range(n)) for n in (1, 3, 6, 2)])
    model = quality.LineModel(rng.normal(size=(2, len(quality.FEATURES))), rng.normal(size=(2, 2)), rng.normal(size=2))
    lines = quality.read_lines(*tv.texts_of(texts))
    label = quality.viterbi(lines, model)
    for d in range(4):
        x = lines.features[lines.doc == d] @ model.emit.T
        paths = list(itertools.product([0, 1], repeat=len(x)))
        value = [model.first[p[0]] + sum(x[k, y] for k, y in enumerate(p)) + sum(model.move[a, b] for a, b in itertools.pairwise(p)) for p in paths]
        assert tuple(label[lines.doc == d]) == paths[int(np.argmax(value))]


def test_trained_crf_keeps_good_documents_and_drops_junk():
    rng = random.Random(4)
    prose = lambda: " ".join(rng.choice(WORDS) for _ in range(12)) + "."
    junk = lambda: " ".join(rng.choice(WORDS) + "###" for _ in range(12))
    make = lambda bad: "\n".join((junk if bad and 0 < k < 9 else prose)() for k in range(10))
    texts = [make(k % 5 == 0) for k in range(200)]
    good = [int(k % 5 != 0) for k in range(200)]
    features = [quality.read_lines(*tv.texts_of(pa.array([t]))).features for t in texts]
    model = quality.fit_crf(features[:150], good[:150])
    _, _, share, _ = quality._judged(*tv.texts_of(pa.array(texts[150:])), model)
    assert ((share >= 0.5) == np.array(good[150:], bool)).all()


def test_secret_spans_match_brute_force(real):
    docs, rows = real
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.findings(docs)).collect()}
    for i, t in rows:
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in plain_secrets(t))


def test_ledger_scans_a_blob_once_per_version_of_the_rules(docs_of, spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = docs_of([(1, "token = abcdefgh"), (2, "clean"), (3, "token = abcdefgh")])
    both = docs_of([(1, "token = abcdefgh"), (4, "new"), (5, "passwd: 12345678")])
    assert secrets.findings(first, path).filter("size(spans) > 0").count() == 2
    assert spark.read.parquet(path).count() == 2
    got = {r["doc_id"]: len(r["spans"]) for r in secrets.findings(both, path).collect()}
    assert got == {1: 1, 4: 0, 5: 1} and spark.read.parquet(path).count() == 4
    secrets.findings(both, path, version="2").collect()
    assert spark.read.parquet(path).count() == 7


# -- 3


def test_packed_pieces_give_back_every_documents_ids(real):
    from tokenizers import Tokenizer

    docs, rows = real
    path = tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, x in rows}
    pieces = packing.pack_documents(docs, path).collect()
    at = dict.fromkeys(want, 0)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert p["start"] == at[p["doc_id"]] and p["doc_tokens"] == len(want[p["doc_id"]])
        at[p["doc_id"]] += p["length"]
        assert zlib.crc32(want[p["doc_id"]][p["start"]:at[p["doc_id"]]].tobytes()) == p["ids_crc32"]
    assert at == {i: len(x) for i, x in want.items()}
    fill = {}
    for p in pieces:
        fill[p["sequence_id"]] = fill.get(p["sequence_id"], 0) + p["length"]
    padding = sum(2048 - n for n in fill.values() if n & (n - 1))
    assert padding <= 0.01 * sum(fill.values())


@pytest.mark.parametrize("limits", [packing.Limits(100, 4, 50), packing.Limits(100, 100, 100), packing.Limits(64, 2, 10)])
def test_every_limit_holds_for_whole_examples(limits):
    rng = np.random.default_rng(3)
    size = rng.integers(1, 60, 300)
    loss = np.minimum(rng.integers(0, 60, 300), size)
    p = packing.Packer(limits, cut=False, keep=20)
    pieces = [x for a in range(0, 300, 50) for x in p.add(np.arange(a, a + 50), size[a:a + 50].copy(), loss[a:a + 50].copy())] + p.finish()
    got = np.zeros(300, int)
    tokens, segments = {}, {}
    for key, _start, n, sequence, offset in pieces:
        assert offset == tokens.get(sequence, 0)
        got[key] += n
        tokens[sequence] = offset + n
        segments[sequence] = segments.get(sequence, 0) + 1
    assert (got == size).all() and max(tokens.values()) <= limits.tokens and max(segments.values()) <= limits.segments
    if limits.loss >= 50:
        whole = {key: sequence for key, start, n, sequence, _ in pieces if n == size[key]}
        total = {}
        for key, sequence in whole.items():
            total[sequence] = total.get(sequence, 0) + loss[key]
        assert max(total.values()) <= limits.loss


def test_dot_product_picks_the_example_most_like_what_is_left():
    p = packing.Packer(packing.Limits(100, 10, 100), cut=False, keep=0)
    pieces = p.add(np.arange(4), np.array([60, 50, 40, 50]), np.array([0, 50, 40, 0]))
    assert pieces[0][0] == 1 and {x[0] for x in pieces if x[3] == 0} == {1, 2}


# -- 6


def test_counts_are_the_librarys_on_odd_texts():
    path = tokenizer("byte_bpe_50k.json")
    t, rng = tokencount.load(path), random.Random(9)
    parts = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\u0085", " ", " ", "　", "a", "the", " foo", "'", "'s", "'LL", "n't", "1", "23", "½", ".", ",", "!?", "é", "中文", "👍🏽", "<|endoftext|>", "<|", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(8000)]
    counter = tokencount.Counter(path, tokencount.prove(path))
    assert counter.count(*tv.texts_of(pa.array(texts))).tolist() == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_proven_strings_encode_as_one_token():
    path = tokenizer("byte_bpe_50k.json")
    proven = tokencount.prove(path)
    assert len(proven) > 40_000 and all(len(e.ids) == 1 for e in tokencount.load(path).encode_batch(proven, add_special_tokens=False))


# -- 9


def test_base_scores_match_brute_force(real):
    docs, rows = real
    want = unigram(rows)
    got = hmm.score(docs).collect()
    for r in got:
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:4]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][4], rel=1e-9)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def tiny_block(rng, classes=3):
    texts = pa.array([" ".join(rng.choice(["ab", "cd", "ef", "gh"], n)) for n in (1, 4, 7)])
    raw, offsets = tv.texts_of(texts)
    return hmm.encode(raw, offsets, classes)


def tiny_model(rng, k=2, classes=3):
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return hmm.Model(norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, classes + 1))))


def paths(block, model, d):
    kinds = block.classes[block.tokens[block.bounds[d]:block.bounds[d + 1]]]
    for z in itertools.product(range(len(model.start)), repeat=len(kinds)):
        p = model.start[z[0]] * np.prod([model.emit[a, x] for a, x in zip(z, kinds, strict=True)]) * np.prod([model.move[a, b] for a, b in itertools.pairwise(z)])
        yield z, kinds, p


def test_forward_sums_over_all_state_paths():
    rng = np.random.default_rng(0)
    block, model = tiny_block(rng), tiny_model(rng)
    for d, got in enumerate(hmm.forward(block, model)):
        assert got == pytest.approx(np.log10(sum(p for _, _, p in paths(block, model, d))))


def test_expected_counts_are_those_of_all_state_paths():
    rng = np.random.default_rng(1)
    block, model = tiny_block(rng), tiny_model(rng)
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
    for d in (0, 2):
        total = sum(p for _, _, p in paths(block, model, d))
        for z, kinds, p in paths(block, model, d):
            start[z[0]] += p / total
            for a, b in itertools.pairwise(z):
                move[a, b] += p / total
            for a, x in zip(z, kinds, strict=True):
                emit[a, x] += p / total
    got = hmm.expected_counts(block, np.array([False, True, False]), model)
    assert np.allclose(got, np.concatenate([start, move.ravel(), emit.ravel()]), rtol=1e-4)


def test_probabilities_of_the_next_word_sum_to_one():
    n, v, c = 50.0, 7, np.array([10, 5, 5, 10, 10, 5, 5])
    assert ((c + 0.1) / (n + 0.1 * (v + 1))).sum() + 0.1 / (n + 0.1 * (v + 1)) == pytest.approx(1.0)


# -- 4


def test_banding_reaches_the_recall_at_the_threshold():
    n, rows = substring.bands(80, 0.995)
    assert 1 - (1 - 0.8 ** rows) ** n >= 0.995 and n <= substring.MOST_BANDS
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(300):
        a = rng.integers(0, 2 ** 63, 90).astype(np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 2 ** 63, 10).astype(np.uint64)])  # Jaccard 0.8
        x = substring.signatures(np.concatenate([a, b]), np.array([0, 90, 180]), n, rows)
        met += bool((x[0] == x[1]).any())
    assert met >= 0.97 * 300


def test_passages_are_caught_wherever_they_stand(docs_of):
    rng = random.Random(8)
    words = [f"q{k}" for k in range(5000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(rng.randrange(60, 90)) for _ in range(15)]
    rows = [(k, say(40) + " " + passages[k % 15] + " " + say(30) + "\n" + say(50)) for k in range(30)]
    line = say(60).split()
    near = list(line)
    near[30] = "changed"
    rows += [(30, " ".join(line)), (31, " ".join(near))]
    clean = [(100 + k, say(120)) for k in range(40)]
    got = substring.repeated_passages(docs_of(rows + clean))
    ids = {r["doc_id"] for r in got.collect()}
    assert ids == set(range(32))
    cut = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs_of(rows + clean), got).collect()}
    for k in range(15):
        assert len(cut[k].split()) > len(cut[15 + k].split()) + 20
    assert all(cut[i] == t for i, t in clean)


# -- 1


@pytest.mark.parametrize("seed", range(4))
def test_repair_costs_no_more_than_any_other(seed):
    rng, costs = random.Random(seed), chat.Costs()
    for _ in range(40):
        roles = [rng.randrange(4) for _ in range(rng.randrange(1, 6))]
        path = chat.best_path(roles, chat.START, None, costs)
        cost = lambda p: _cost(roles, p, costs)
        assert cost(path) == pytest.approx(min(cost(list(p)) for p in itertools.product(range(1, 4), repeat=len(roles))))


def _cost(roles, path, costs):
    step, _ = chat._steps(costs)
    states = [chat.START, *path]
    return (sum(step[a, b] for a, b in itertools.pairwise(states)) + sum(costs.relabel for r, t in zip(roles, path, strict=True) if r != t)
            + costs.insert * len(chat._END[states[-1]]))


def test_chunks_give_the_same_as_one_task(spark):
    rng = random.Random(6)
    rows = [(c, k, rng.choice(["user", "assistant", "system", "tool"]), f"t{k}") for c in range(6) for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r["conv_id"]: r for r in chat.repair(df).collect()}
    parts = chat.repair(df, chunk=7).orderBy("conv_id", "chunk").collect()
    for c in range(6):
        mine = [r for r in parts if r["conv_id"] == c]
        assert len(mine) == 6 and sum(r["cost"] for r in mine) == pytest.approx(whole[c]["cost"])
        for text in ("".join(r["rendered"] for r in mine), whole[c]["rendered"]):
            roles = re.findall(r"<\|(system|user|assistant)\|>", text)
            assert roles[roles[0] == "system":] == ["user", "assistant"] * (len(roles) // 2)
            assert re.findall(r"t\d+", text) == [f"t{k}" for k in range(40)]


# -- 2


def test_licenses_are_found_in_held_out_wording():
    rng = random.Random(1)
    unknown = [" ".join(rng.choice(WORDS) for _ in range(15)) for _ in range(300)]
    model = licenses.fit(unknown[:200])
    cases = {"RELEASED under the MIT license": "mit", "this work is licensed under the gnu general public license version 3": "gpl",
             "Portions licensed under the Apache License, Version 2.0, see NOTICE": "apache-2.0", "Licensed under CC BY-SA 4.0": "cc-by-sa",
             "the license of the public may be granted to rights": "unknown"}
    texts = [*cases, *unknown[200:]]
    f = licenses.classify(*tv.texts_of(pa.array(texts)), model)
    got = {int(d): licenses.FAMILIES[k] for d, k in zip(f.doc, f.family, strict=True)}
    assert [got.get(k, "unknown") for k in range(len(cases))] == list(cases.values())
    assert not [d for d in got if d >= len(cases)]


def test_every_operator_has_its_query():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
