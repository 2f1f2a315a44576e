import random

import numpy as np
import pyarrow as pa
from helpers import words

from trustlens.llm.textscan import mix, run_hashes, run_starts, scan, sliding


def _texts():
    rng = random.Random(1)
    pick = ["a", "bb", "ccc", "eightbyt", "longer than eight".replace(" ", ""), "é", "\x1c", "\xa0x"]
    return [rng.choice(["", " ", "\n"]).join(rng.choice(pick) for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None, "", " \t\x0b"]


def test_words_are_the_runs_of_other_bytes():
    texts = _texts()
    w = scan(pa.array(texts))
    got = [[w.data[w.start[j] : w.start[j] + w.length[j]].tobytes().decode() for j in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [words(t) for t in texts]


def test_sliced_and_folded_columns():
    column = pa.array(["drop", "Ab É", None, "c"]).slice(1)
    w = scan(column, lower=True)
    assert w.counts.tolist() == [2, 0, 1]
    assert w.hashes()[0] == scan(pa.array(["ab"])).hashes()[0]


def test_hashes_tell_words_and_runs_apart():
    texts = _texts()
    w = scan(pa.array(texts))
    flat = [x for t in texts for x in words(t)]
    h = w.hashes()
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    owner = np.repeat(np.arange(len(texts)), w.counts)
    for k in (1, 2, 3, 5, 7, 35):
        runs, inside = run_hashes(h, k), run_starts(w.first, k, len(h))
        assert (inside == (owner[: len(runs)] == owner[k - 1 : k - 1 + len(runs)])).all()
        pairs = {(tuple(flat[i : i + k]), int(runs[i])) for i in range(len(runs))}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_sliding_and_mix():
    v = np.random.default_rng(0).integers(0, 99, 200)
    for k in (1, 2, 3, 7, 28):
        assert (sliding(v, k, np.maximum) == np.lib.stride_tricks.sliding_window_view(v, k).max(1)).all()
    assert len(np.unique(mix(np.arange(100000, dtype=np.uint64)))) == 100000
