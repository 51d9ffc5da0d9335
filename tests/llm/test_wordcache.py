"""The word cache of the packing workers: what it encodes at once, and with how many threads."""

import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa

from userlens.llm import textvec as tv
from userlens.llm.wordcache import IdCache


def test_new_words_are_encoded_some_at_a_time():
    asked = []

    def encode(words):
        asked.append(len(words))
        return [[int(w[1:]), 7][:int(w[1:]) % 3] for w in words]

    cache = IdCache(encode)
    for low, high in ((0, 9001), (4000, 13_000), (0, 100)):  # new words, some new, none new
        numbers = [k for k in range(low, high) for _ in range(1 + k % 2)]
        w = tv.words_of(*tv.texts_of(pa.array([" ".join(f"w{k}" for k in numbers)])))
        ids, n = cache.ids(w.raw, w.start, w.end, w.hashes())
        assert ids.tolist() == [x for k in numbers for x in [k, 7][:k % 3]]
        assert n.tolist() == [k % 3 for k in numbers]
    assert max(asked) <= 4096 and sum(asked) == 13_000


THREADS = """
import os, sys
import pyarrow as pa
from userlens.llm import packing, textvec as tv
from userlens.llm.queries import tokenizer
cache = packing._cache(tokenizer("word_bpe_49k.json"))
before = len(os.listdir("/proc/self/task"))
packing.document_ids(*tv.texts_of(pa.array([" ".join(f"word{k}" for k in range(5000))])), cache)
print(len(os.listdir("/proc/self/task")) - before)
"""


def test_a_packing_worker_encodes_in_one_thread():
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    env["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), env.get("PYTHONPATH", "")])
    got = subprocess.run([sys.executable, "-c", THREADS], env=env, capture_output=True, text=True, timeout=120, check=True)
    assert got.stdout.split() == ["0"]
