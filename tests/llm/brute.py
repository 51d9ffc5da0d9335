"""Plain versions of the operators' results, for small inputs."""

import math
import re
import zlib
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, n=3):
    w = SPACE_WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)])


def jaccard_components(rows, percent=90, words=3):
    """[(doc_id, text)] -> {doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t, words) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def contamination(text, items, window=10):
    """n_words, n_hit, item ids with windows in the text (as sorted strings)."""
    w = ALNUM_WORD.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        x = ALNUM_WORD.findall(lower(t))
        for k in range(max(1, len(x) - window + 1) if x else 0):
            g = x[k:k + window]
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = SPACE_WORD.findall(text)
    grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def secrets(text):
    text, spans = text or "", []
    rules = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A),
             ("access", r"AKIA[A-Z0-9]+", 0, 20, 0), ("hex", r"[0-9a-f]+", 0, 24, 0)]
    for k, (kind, pattern, group, least, flags) in enumerate(rules):
        spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


def unigram(rows):
    """{doc_id: (held_out, n_tokens, n_known, N, base_score)}; ids are distinct."""
    toks = {i: [*SPACE_WORD.findall(lower(t)), None] for i, t in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in toks}
    c = Counter(x for i in toks if not held[i] for x in toks[i])
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in toks.items()}
