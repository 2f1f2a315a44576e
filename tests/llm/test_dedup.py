import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import corpus, documents, words

import __spark_entry__
from trustlens.llm import linededup, neardup, substring
from trustlens.llm.components import connected_components


@pytest.fixture(scope="module")
def rows():
    return corpus()


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _bag(found):
    return Counter(tuple(r) for r in found)


# --- op 2 ---------------------------------------------------------------------


def _substring(rows, width):
    windows = Counter(tuple(w[i : i + width]) for w in (words(t) for _, t in rows) for i in range(len(w) - width + 1))
    for doc_id, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - width + 1) if windows[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        yield doc_id, len(w), len(gone), _sha(" ".join(x for i, x in enumerate(w) if i not in gone))


@pytest.mark.parametrize("width", [35, 6])
def test_substring_agrees_with_brute_force(spark, rows, width):
    got = substring.drop_repeated_windows(documents(spark, rows), width, digest=True).collect()
    assert _bag(got) == _bag(_substring(rows, width))


def test_substring_over_many_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(substring, "TILE_BYTES", 3000)
    monkeypatch.setattr(substring, "SHARD_BYTES", 5000)
    got = substring.drop_repeated_windows(documents(spark, rows), digest=True).collect()
    assert _bag(got) == _bag(_substring(rows, 35))


def test_substring_of_nothing(spark):
    assert substring.drop_repeated_windows(documents(spark, [])).collect() == []
    assert [tuple(r) for r in substring.drop_repeated_windows(documents(spark, [(1, None)])).collect()] == [(1, 0, 0, "")]


# --- op 9 ---------------------------------------------------------------------


def _sets(rows):
    out = []
    for _, text in rows:
        w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    return out


def _neardup(rows, threshold):
    sets, ids = _sets(rows), [i for i, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]) or ids[i] is not None and ids[i] == ids[j]:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(ids[i])
    for i, s in enumerate(sets):
        named = [x for x in groups[root(i)] if x is not None]
        component = min(named) if named else None
        yield ids[i], len(s), component, ids[i] is not None and ids[i] == component


@pytest.mark.parametrize("threshold", [75, 90])
def test_near_duplicates_agree_with_brute_force(spark, rows, threshold):
    got = neardup.near_duplicates(documents(spark, rows), threshold).collect()
    assert _bag(got) == _bag(_neardup(rows, threshold))


def test_rows_of_one_id_are_one_document(spark):
    s, t, u = ("one two three four five six", "alpha beta gamma delta epsilon zeta eta", "no such words in any other text")
    some = [(1, s), (5, s), (5, t), (9, t), (5, ""), (7, u), (7, None), (8, ""), (None, t)]
    got = neardup.near_duplicates(documents(spark, some)).collect()
    assert _bag(got) == _bag(_neardup(some, 75))
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 5: 1, 9: 1, 7: 7, 8: 8, None: 1}
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 3, 7]))) for _ in range(12)]
    many = [(rng.randint(0, 25), rng.choice(texts)) for _ in range(60)]
    assert _bag(neardup.near_duplicates(documents(spark, many)).collect()) == _bag(_neardup(many, 75))
    kept = neardup.drop_near_duplicates(documents(spark, some)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 7, 8]


def test_near_duplicates_across_blocks(spark, monkeypatch):
    # variants of one text that resemble a hidden middle, not each other
    monkeypatch.setattr(neardup, "BLOCK", 4)
    base = [f"t{i}" for i in range(60)]
    rows = [(100 + k, " ".join(base[: 4 * k] + [f"x{k}"] + base[4 * k + 1 :])) for k in range(14)] + [(200, " ".join(base)), (300, "else " * 3 + "where")]
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    assert _bag(got) == _bag(_neardup(rows, 75))


def test_one_document_of_each_group_stays(spark, rows):
    docs = documents(spark, rows)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = Counter({i: 1 for i in {d for d, _, _, k in _neardup(rows, 75) if k}})
    expected[None] = 2
    assert Counter(r.doc_id for r in kept.collect()) == expected


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(documents(spark, [])).collect() == []


def test_register_estimates():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    sets = [np.unique(np.concatenate([common, x])) for x in (a, b)] + [np.unique(a[:3])] * 2
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    r = neardup.registers(np.concatenate(sets), first)
    n = np.diff(first)
    guess = neardup.estimate(r[[0, 2, 0]], r[[1, 3, 2]], n[[0, 2, 0]], n[[1, 3, 2]])
    assert abs(guess[0] - 0.6) < 0.2 and guess[1] == 1 and guess[2] < 0.2
    assert 0 < neardup.collision_rate(np.array([800]), np.array([800]))[0] < 0.01


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40) if k % 10 != 9] + [(100, 5), (100, 25), (7, 7), (None, 3), (5, 100)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(10)}, **{k: 10 for k in range(10, 20)}, **{k: 0 for k in range(20, 30)}, **{k: 30 for k in range(30, 40)}, 100: 0}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- op 10 --------------------------------------------------------------------


def _lines(rows, least):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    solid = {i: [x for x in (rows[i][1] or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")] for i in order}
    seen, gone = set(), defaultdict(set)
    for i in order:
        for j in range(len(solid[i]) - least + 1):
            run = tuple(solid[i][j : j + least])
            if run in seen:
                gone[i].update(range(j, j + least))
            seen.add(run)
    for i in order:
        kept, n = [], 0
        for x in (rows[i][1] or "").split("\n"):
            if x.strip(" \t\n\r\x0b\x0c"):
                n += 1
                if n - 1 in gone[i]:
                    continue
            kept.append(x)
        yield rows[i][0], n, len(gone[i]), _sha("\n".join(kept))


@pytest.mark.parametrize("least", [1, 3, 4])
def test_lines_agree_with_brute_force(spark, least):
    rows = [r for r in corpus(4) if r[0] is not None] + [(5000, "x\ny\nz\n\nx\n \ny\nz\nx"), (5001, "y\nz\nx")]
    got = linededup.drop_repeated_lines(documents(spark, rows), least, digest=True).collect()
    assert _bag(got) == _bag(_lines(rows, least))


def test_lines_of_null_ids_come_last(spark):
    got = linededup.drop_repeated_lines(documents(spark, [(None, "a\nb\nc"), (9, "a\nb\nc"), (3, None)])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 3, 3, ""), (9, 3, 0, "a\nb\nc"), (3, 0, 0, "")], key=str)
    assert linededup.drop_repeated_lines(documents(spark, [])).collect() == []


def test_a_registered_query_takes_runs_of_any_length(spark, tmp_path):
    rows = [(1, "only line"), (2, "only line"), (3, "a\nb\n\nc"), (4, "b\nx\na\nb"), (5, "y\ny\nz")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = __spark_entry__.queries()["line_dedup_any_run"](spark, str(tmp_path)).collect()
    assert _bag(got) == _bag(_lines(rows, 1))
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 1, 3: 0, 4: 3, 5: 1}
