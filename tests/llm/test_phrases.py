"""Counting quotient filters, and collocations against a plain count."""

import re
from collections import Counter

import numpy as np
import pytest

from trustlens.llm import phrases
from trustlens.llm.quotient import count_keys, merge, pack, permute, restore, split, unmix, unpack
from trustlens.llm.textscan import mix

from helpers import corpus, documents


@pytest.mark.parametrize("lanes", [1, 2, 3, 5])
@pytest.mark.parametrize("shard_bits", [0, 3, 10])
def test_filters_lose_nothing(lanes, shard_bits):
    rng = np.random.default_rng(lanes)
    keys = [rng.integers(0, 40, 20_000).astype(np.uint64) for _ in range(lanes)]
    keys[0][:700] = 2**64 - 1  # one key often enough for a counter of more than a byte
    for k in keys[1:]:
        k[:700] = 0
    permuted = permute(keys)
    assert all((a == b).all() for a, b in zip(restore(permuted), keys))
    distinct, counts = count_keys(permuted)
    blobs = dict(split(distinct, counts, shard_bits))
    want = Counter(zip(*(k.tolist() for k in keys)))
    got = Counter()
    for blob in blobs.values():
        back, n = merge([blob, blob])
        assert (np.diff(back[0].astype(object)) >= 0).all()  # in order
        got.update(dict(zip(zip(*(k.tolist() for k in restore(back))), n.tolist())))
    assert got == {k: 2 * n for k, n in want.items()}


def test_filters_of_one_key_and_of_equal_first_lanes():
    one = [np.array([7], np.uint64), np.array([9], np.uint64)]
    for bits in (0, 5):
        keys, counts = unpack(pack(one, np.array([3]), bits))
        assert [k.tolist() for k in keys] == [[7], [9]] and counts.tolist() == [3]
    same = [np.zeros(6, np.uint64), np.array([2, 1, 2, 1, 1, 3], np.uint64)]
    keys, counts = count_keys(same)
    assert keys[1].tolist() == [1, 2, 3] and counts.tolist() == [3, 2, 1]
    x = np.arange(1000, dtype=np.uint64) * np.uint64(2**54 + 3)
    assert (unmix(mix(x)) == x).all()


def plain(rows, max_words=3, least=10, percent=50, first=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, words), a in f.items():
        if len(words) > 1 and a >= least:
            cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[lang, words] = (a, f[lang, words[:k]], f[lang, words[k:]], score)
    covered = set()
    for lang, long in found:
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                if 100 * f[lang, long] >= percent * f[lang, long[i : i + k]]:
                    covered.add((lang, long[i : i + k]))
    out = set()
    for lang in n:
        own = [(-s, -a, " ".join(w).encode(), a, l, r) for (x, w), (a, l, r, s) in found.items() if x == lang and (x, w) not in covered]
        for rank, (s, _, phrase, a, l, r) in enumerate(sorted(own)[:first], 1):
            out.add((lang, rank, phrase.decode(), a, l, r, n[lang], -s))
    return out


def rows_of(seed):
    rows = [(i, t, ("en", "de", None)[k % 3]) for k, (i, t) in enumerate(corpus(seed))]
    rows += [(900 + i, "Ha ha ha ha. New York, new york! new\tyork city; a.b", "en") for i in range(14)]
    rows += [(950, "é ü é ü " * 30, "x y"), (951, "tab\vbed\x00word a\x00b " * 12, "")]
    return rows


@pytest.mark.parametrize("shard_bits,flush", [(None, 1 << 21), (4, 500)])
def test_collocations_equal_a_plain_count(spark, monkeypatch, shard_bits, flush):
    monkeypatch.setattr(phrases, "FLUSH", flush)
    if shard_bits is not None:
        monkeypatch.setattr(phrases, "SHARD_KEYS", 200)
        monkeypatch.setattr(phrases, "RANK_ROWS", 40)
    rows = rows_of(3)
    got = phrases.mine_collocations(documents(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain(rows)


def test_other_settings(spark):
    rows = rows_of(4)
    got = phrases.mine_collocations(documents(spark, rows), max_words=4, min_count=5, covered_percent=80, per_language=7)
    assert {tuple(r) for r in got.collect()} == plain(rows, 4, 5, 80, 7)


def test_counts_beyond_64_bits(spark):
    """a a 1000000 of ten million occurrences passes 2^64."""
    tables = {1: [("en", 10_000_000, 1), ("en", 10_000_001, 2)], 2: [("en", 9_999_999, 1, 2)]}
    frames = {n: spark.createDataFrame(r, "lang string, f long, " + ", ".join(f"w{j} long" for j in range(1, n + 1))) for n, r in tables.items()}
    row = phrases._candidates(frames, 2).collect()[0]
    assert row.score == 1_000_000 * 9_999_999**2 // (10_000_000 * 10_000_001)


def test_words_that_share_an_id_make_another_seed(spark, monkeypatch):
    real = phrases.word_ids

    def clashing(words, seed):
        ids = real(words, seed)
        return ids if seed else np.minimum(ids, np.uint64(2**62))  # most ids equal, under the first seed

    monkeypatch.setattr(phrases, "word_ids", clashing)
    rows = rows_of(5)[:40]
    _, _, seed = phrases.frequent_phrases(documents(spark, rows).select("text", "lang"))
    assert seed == 1


def test_empty_table(spark):
    assert phrases.mine_collocations(documents(spark, [])).collect() == []
    assert phrases.mine_collocations(documents(spark, [(1, None), (2, ""), (3, " ., ")])).collect() == []
