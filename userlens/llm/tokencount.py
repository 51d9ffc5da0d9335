"""Token counts by the whole-token shortcut.

``prove`` shows offline which vocabulary strings encode alone as one token. Texts are cut into
units at places where the tokenizer's own pre-tokenizer always cuts, whatever stands around:
before a run of white space, and between ASCII letters, digits and other characters (but not
after an apostrophe, where contractions are matched). A unit in the proven set counts as one
token directly; the merges run only for the other distinct units, once per worker, and a text's
count is the sum over its units. Units are looked up by 64-bit hash, all of a batch at once.

White space outside ASCII doesn't end a unit before white space, as the pre-tokenizer takes both
as one run; a special token's string inside a text is a unit of its own, which the library
encodes as its default says. So the counts equal the library's on whole texts.

Narrow: no shuffle; the vocabulary is the only thing that is sent to the tasks.

Defined results: a null text is empty and has 0 bytes and 0 tokens; a null id stays; repeated rows
are counted each; an empty table gives an empty table; other columns, whatever their names, are
not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .wordcache import HashMap

LIMIT = 512

_KIND = np.full(256, 3, dtype=np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other, 4 not ASCII
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[128:] = 4
#: UTF-8 of white space outside ASCII.
WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
#: What else white space by some definitions is; it isn't cut off either.
_ODD_SPACE = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F])


def load(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which a byte-level vocabulary writes the 256 bytes: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def prove(path: str) -> list[str]:
    """The vocabulary's strings that are one unit and that the tokenizer encodes as one token."""
    t = load(path)
    alphabet = byte_alphabet()
    strings = []
    for token in json.loads(t.to_str())["model"]["vocab"]:
        try:
            strings.append(bytes(alphabet[c] for c in token).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue  # a part of a character
    encoded = t.encode_batch_fast(strings, add_special_tokens=False)
    return sorted(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1)


def unit_starts(raw: np.ndarray, offsets: np.ndarray, specials: list[bytes] = ()) -> np.ndarray:
    """Where units begin."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KIND[raw]
    was, now = kind[:-1], kind[1:]
    cut = np.zeros(n, dtype=bool)
    cut[1:] = (((now == 0) & (was != 0))
               | ((was != now) & (was > 0) & (was < 4) & (now > 0) & (now < 4) & (raw[:-1] != 39))) & ~_ODD_SPACE[raw[:-1]] & ~_ODD_SPACE[raw[1:]]
    spots = np.flatnonzero(cut[1:] & (now == 0) & (was == 4)) + 1
    if len(spots):
        for wide in WIDE_SPACE:
            k = len(wide)
            hit = spots[spots >= k]
            for j, b in enumerate(wide):
                hit = hit[raw[hit - k + j] == b]
            cut[hit] = False
    if specials:
        data = raw.tobytes()
        for s in specials:
            at = data.find(s)
            while at >= 0:
                cut[at + 1:at + len(s)] = False
                cut[at] = True
                if at + len(s) < n:
                    cut[at + len(s)] = True
                at = data.find(s, at + len(s))
    starts = offsets[:-1]
    cut[starts[starts < n]] = True
    return np.flatnonzero(cut)


class Counter:
    """Token counts per distinct unit, seeded with the proven ones."""

    def __init__(self, path: str, proven: list[str]) -> None:
        self.tokenizer = load(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        raw, offsets = tv.texts_of(pa.array(proven, pa.large_string()))
        real = np.flatnonzero(np.diff(offsets))
        self.seeds = np.unique(tv.span_hashes(raw, offsets[real], offsets[real + 1])) if len(real) else np.zeros(0, np.uint64)
        self.map = HashMap()
        self._seed()

    def _seed(self) -> None:
        self.map.clear()
        self.map.add(self.seeds, np.ones(len(self.seeds), np.int64))

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        start = unit_starts(raw, offsets, self.specials)
        end = np.append(start[1:], len(raw))
        keys, first, which = np.unique(tv.span_hashes(raw, start, end), return_index=True, return_inverse=True)
        if len(self.map) > self.map.limit:
            self._seed()
        value, found = self.map.get(keys)
        if not found.all():
            new = np.flatnonzero(~found)
            data, at = raw.tobytes(), first[new]
            units = [data[a:b].decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            value[new] = [len(e.ids) for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
            self.map.add(keys[new], value[new])
        doc = np.searchsorted(offsets, start, side="right") - 1
        return np.bincount(doc, weights=value[which], minlength=len(offsets) - 1).astype(np.int64)


#: The counters of this Python worker.
_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of ``docs``."""
    proven = docs.sparkSession.sparkContext.broadcast(prove(tokenizer))  # at most the vocabulary
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer, proven.value)
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                n = counter.count(raw[o[0]:o[-1]], o - o[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(o)), pa.array(n), pa.array(n > limit)], names=names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
