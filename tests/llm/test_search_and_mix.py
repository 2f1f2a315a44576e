import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus, documents, words

from trustlens.llm import decontam, mixing, storage, topk


# --- op 4 ---------------------------------------------------------------------


def _brute_tiles(a, b, shortest):
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n >= shortest and (n, -i, -j) > best:
                    best = (n, -i, -j)
        if not best[0]:
            return out
        n, i, j = best[0], -best[1], -best[2]
        out.append((i, j, n))
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False


def test_tiles_are_the_greedy_ones():
    rng = random.Random(2)
    for t in range(200):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(0, n))] for n in (25, 30))
        if t % 2 and len(a) > 6:
            c = rng.randint(2, len(a) - 2)
            b = b[:5] + a[c:] + b[5:8] + a[:c] + b[8:]
        assert decontam.tiles(np.array(a, np.uint64), np.array(b, np.uint64)) == _brute_tiles(a, b, decontam.MATCH)


def _plain(text):
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()


def _contaminated(rows, items):
    for doc_id, text in rows:
        best = (0.0, None)
        for item_id, item in sorted(items):
            a = _plain(item)
            share = sum(n for _, _, n in _brute_tiles(a, _plain(text), decontam.MATCH)) / len(a) if len(a) >= decontam.MATCH else 0
            if share >= decontam.COVERAGE and share > best[0]:
                best = (share, item_id)
        yield doc_id, best[1], best[0], best[1] is not None


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 100])
def test_contamination_agrees_with_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    rng = random.Random(7)
    line = lambda n: " ".join(f"w{rng.randint(0, 40)}" for _ in range(n))
    items = [(k, line(rng.randint(2, 25))) for k in range(8)]
    items += [(20, items[3][1]), (21, "one two three"), (22, "Éa, bé! CÉ dé; e")]
    parts = items[5][1].split(" ")
    rows = [(k, line(rng.randint(0, 40))) for k in range(12)]
    rows += [(50, line(9) + " " + items[3][1].upper().replace(" ", ", ") + "! " + line(5)), (51, line(4) + " ".join(parts[6:] + ["x"] + parts[:6]))]
    rows += [(52, "éa bé cé dé e"), (53, None), (54, ""), (None, items[6][1]), (55, items[6][1]), (55, items[6][1]), (56, (items[4][1] + " ") * 40)]
    bench = spark.createDataFrame([*items, (None, "a b c d e"), (30, None), (31, "")], "item_id long, text string")
    got = decontam.find_contaminated(documents(spark, rows), bench).collect()
    round_ = lambda r: (r[0], r[1], round(r[2], 9), r[3])
    assert Counter(round_(tuple(r)) for r in got) == Counter(round_(r) for r in _contaminated(rows, items))
    by = {r.doc_id: r for r in got}
    assert by[50].contaminated and by[50].item_id == 3 and by[52].item_id == 22
    kept = decontam.drop_contaminated(documents(spark, rows), bench)
    assert kept.columns == documents(spark, []).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if not r.contaminated)


def test_shared_seeds_are_looked_at_in_groups(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SEED_ROWS", 3)
    items = [(k, f"common words of all items and {k} more of its own {k}") for k in range(5)]
    rows = [(10 + k, items[k][1] + " then common words of all items") for k in range(5)] + [(20, "nothing here at all")]
    got = {r.doc_id: (r.item_id, r.coverage) for r in decontam.find_contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {**{10 + k: (k, 1.0) for k in range(5)}, 20: (None, 0.0)}


def test_a_text_that_repeats_what_an_item_repeats_takes_memory_by_its_length():
    item = " ".join("abcd"[k % 4] for k in range(300))
    text = " ".join("abcd"[k % 4] if k % 50 else "gap" for k in range(4000))
    block = decontam.Benchmark([1], [item])
    tracemalloc.start()
    try:
        assert list(block.matches(pa.array([text]))) == [(0, 1, 294 / 300, 49)]
        assert tracemalloc.get_traced_memory()[1] < 5 << 20
    finally:
        tracemalloc.stop()


def test_batches_of_texts_are_bounded(spark):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "64m")
        wide = storage.wide_rows(spark.range(60).selectExpr("id", "repeat('x', 1000000) as text").coalesce(1))
        rows = wide.mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r.n for r in rows) == 60 and max(r.n for r in rows) <= 9
        spark.conf.set(conf, "1m")  # a lower setting is kept
        storage.wide_rows(spark.range(1))
        assert spark.conf.get(conf) == "1m"
    finally:
        spark.conf.set(conf, before)


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 100])
def test_a_long_passage_of_a_long_item(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    item = [f"w{k}" for k in range(300)]
    items = [(1, " ".join(item)), (2, "a short item of seven words only")]
    least = decontam.PASSAGE
    rows = [(1, "before " + " ".join(item[50:150]) + " after"), (2, " ".join(item[-least:])), (3, " ".join(item[: least - 1]))]
    # many short pieces are no passage; a short item of a higher share does not hide one
    rows += [(4, " x ".join(" ".join(item[k : k + 5]) for k in range(0, 100, 10))), (5, rows[0][1] + " a short item of seven words or so")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.item_id, round(r.coverage, 9), r.contaminated) for r in decontam.find_contaminated(documents(spark, rows), bench, 0.9).collect()}
    assert got == {1: (1, round(1 / 3, 9), True), 2: (1, least / 300, True), 3: (None, 0.0, False), 4: (None, 0.0, False), 5: (1, round(1 / 3, 9), True)}
    assert {r.doc_id for r in decontam.drop_contaminated(documents(spark, rows), bench).collect()} == {3, 4}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_contaminated(documents(spark, []), none).collect() == []
    assert not decontam.find_contaminated(documents(spark, [(1, "a b c d e")]), none).first().contaminated
    with pytest.raises(ValueError, match="coverage"):
        decontam.find_contaminated(documents(spark, []), none, 0.1)


# --- op 6 ---------------------------------------------------------------------


def _targets(sizes, weights, limit):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest, share = total - sum(limit * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * rest > limit * sizes[s] * share}
        if not over:
            return {s: float(limit * sizes[s]) if s in full else rest * weight[s] / share for s in names}
        full |= over


def _mixed(rows, weights=(1, 2, 3), limit=3):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    targets = _targets(sizes, weights, limit)
    for doc_id, text, _, source in rows:
        size = len(words(text))
        rate = targets[source] / sizes[source] if sizes[source] else 0.0
        draw = int(hashlib.md5(f"mix:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        copies = int(rate) + (draw < rate - int(rate))
        yield doc_id, size, sizes[source], targets[source], copies * size, copies


def _sourced():
    rng = random.Random(3)
    rows = [(i, t, None, rng.choice(["a", "b", "B", "é", "hot", "hot", "hot", None])) for i, t in corpus()]
    return rows + [(9001, "one two", None, "tiny"), (9002, None, None, "empty"), (9003, "", None, "empty")]


@pytest.mark.parametrize("weights,limit", [((1, 2, 3), 3), ((5,), 1), ((1, 9), 2)])
def test_mixture_agrees_with_brute_force(spark, weights, limit):
    rows = _sourced()
    got = mixing.mix_counts(documents(spark, rows), weights, limit)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()) == Counter(
        (i, n, s, round(t, 6), k) for i, n, s, t, k, _ in _mixed(rows, weights, limit)
    )
    total = sum(len(words(t)) for _, t, _, _ in rows)
    assert abs(sum(dict((r.source_size, r.target) for r in got.collect()).values()) - total) < 1e-6 * total or limit == 1


def test_mixed_rows_are_copies(spark):
    rows = _sourced()
    docs = documents(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    expected = Counter()
    for (i, *_, copies), (_, text, _, source) in zip(_mixed(rows), rows):
        expected[i, text, source] += copies
    assert Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == +expected


def test_mixing_nothing(spark):
    assert mixing.mix_counts(documents(spark, [])).collect() == []
    assert mixing.mix(documents(spark, [])).collect() == []
    got = mixing.mix_counts(documents(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


# --- op 7 ---------------------------------------------------------------------


def _vectors(seed=5, n=400, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dims))
    rows = [(int(i), (centres[i % 6] + rng.normal(0, 0.1, dims)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1050, [0.0] * dims), (50, rows[3][1]), (-100, rows[7][1])]
    rows += [(1003, None), (None, rows[0][1]), (1100, [float("nan")] * dims), (1150, [None] + [0.1] * (dims - 1)), (1200, [float("inf")] * dims)]
    rows += [(1250, []), (1300, [0.5, -0.5]), (1301, [0.25, 0.25]), (1302, rows[1][1]), (1302, rows[1][1])]
    return rows


def _top(rows, k, every):
    clean = [(i, np.floor(np.array(v, np.float64) * 256).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q in sorted({(i, tuple(v)) for i, v in clean if i % every == 0}):
        yield q, [(int(v @ np.array(q[1])), i) for i, v in clean if i != q[0] and len(v) == len(q[1])]


@pytest.mark.parametrize("k,block,queries", [(5, topk.BLOCK, topk.QUERY_BLOCK), (3, 600, 3)])
def test_top_k_agrees_with_brute_force(spark, monkeypatch, k, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", queries)
    rows = _vectors()
    docs = spark.createDataFrame([(i, v, 1, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score int, block string")
    found = defaultdict(list)
    for r in topk.top_k(docs, k).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    expected = defaultdict(list)
    for (q, _), scored in _top(rows, k, 50):
        expected[q] += scored
    assert set(found) == {q for q, s in expected.items() if s}
    for q, scored in expected.items():
        best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
        assert sorted(found[q]) == [(i + 1, v, s) for i, (s, v) in enumerate(best)]


def test_search_proves_what_it_leaves_out():
    rng = np.random.default_rng(0)
    x = rng.integers(-120, 120, (3000, 24))
    index = topk.ImpactIndex(x)
    for q in [*x[:30], np.zeros(24, int), np.r_[np.zeros(23, int), 7]]:
        members, scores = index.search(q, 5)
        exact = x @ q
        assert (scores == exact[members]).all()
        assert set(np.flatnonzero(exact >= np.sort(exact)[-5])) <= set(members.tolist())


@pytest.mark.parametrize("size", [1 << 17, 1 << 24, 1 << 26])
def test_bounds_of_large_components_do_not_wrap(size):
    rng = np.random.default_rng(1)
    x = rng.integers(-size, size, (300, 1024))
    x[:40] = abs(x[:40])
    index = topk.ImpactIndex(x)
    for q in x[:5]:
        members, scores = index.search(q, 5)
        exact = [sum(a * b for a, b in zip(v, q.tolist())) for v in x.tolist()]
        assert scores.tolist() == [exact[m] for m in members]
        assert {i for i, s in enumerate(exact) if s >= sorted(exact)[-5]} <= set(members.tolist())


def test_components_beyond_32_bits(spark):
    rows = [(50, [1e7, -2.0]), (1, [1e7, 3.0]), (2, [-1e7, 3.0]), (3, [9e6, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.rank, r.vec_id, r.score) for r in topk.top_k(vectors).collect()}
    (_, scored), = _top(rows, 5, 50)
    assert got == {(i + 1, v, s) for i, (s, v) in enumerate(sorted(scored, reverse=True))}
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(spark.createDataFrame([(50, [1e17]), (1, [1.0])], vectors.schema)).collect()


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(none).collect() == []
    one = spark.createDataFrame([(50, [0.5], 1)], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(one).collect() == []
