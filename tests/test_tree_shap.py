"""Exact tree attributions against the enumeration of all feature subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlens.operators import explain as X
from trustlens.operators import model as M
from trustlens.operators import tree_shap as TS
from trustlens.operators.explain import feature_arrays, feature_names


def listings(spark, n=160, seed=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 4, n).astype(float), rng.normal(size=n)
    cat = rng.choice(["x", "y", "z"], n)
    y = 2 * (a > 0.3) * (b > 1) + c * (cat == "y") + 0.1 * rng.normal(size=n)
    rows = [(f"p{i}", float(a[i]), float(b[i]), float(c[i]), str(cat[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "product_id string, a double, b double, c double, main_category string, bayesian_rating double")


def enumerated(predict, x, background):
    """Shapley values of one row, by the definition."""
    k = len(x)
    value = {}
    for r in range(k + 1):
        for s in itertools.combinations(range(k), r):
            mixed = background.copy()
            mixed[:, list(s)] = x[list(s)]
            value[frozenset(s)] = predict(mixed).mean()
    out = np.zeros(k)
    for i in range(k):
        for s in value:
            if i not in s:
                w = math.factorial(len(s)) * math.factorial(k - len(s) - 1) / math.factorial(k)
                out[i] += w * (value[s | {i}] - value[s])
    return out


@pytest.mark.parametrize("name,block_nodes", [("Random Forest", 100_000), ("Random Forest", 30), ("Gradient Boosting", 100_000)])
def test_equals_subset_enumeration(spark, monkeypatch, name, block_nodes):
    monkeypatch.setattr(M, "N_TREES", 5)
    monkeypatch.setattr(M, "N_ROUNDS", 5)
    df, numeric = listings(spark), ["a", "b", "c"]
    train = df.where("product_id < 'p5'")
    model = M.fit_model(name, train, numeric, max_depth=5)
    trees = TS.as_trees(TS.tree_nodes(model).collect())
    x = np.array([r.x for r in feature_arrays(model, df).collect()])
    background = np.array([r.x for r in feature_arrays(model, train).collect()])
    predict = lambda m: sum(t.predict(m) for t in trees)
    own = [r.prediction for r in model.transform(df).collect()]
    assert np.allclose(predict(x), own, atol=1e-12)  # the flat table is the model
    names = feature_names(model, numeric)
    got = {}
    for r in TS.shap_trees(model, df, train, numeric, block_nodes).collect():
        got.setdefault(r.product_id, {})[r.feature] = (r.feature_value, r.shap_value)
    assert len(got) == len(x)
    mean = predict(background).mean()
    for i, r in enumerate(df.collect()):
        mine = got[r.product_id]
        assert [mine[n][0] for n in names] == x[i].tolist()
        assert sum(v for _, v in mine.values()) == pytest.approx(own[i] - mean, abs=1e-10)
        if i % 8 == 0:
            assert np.allclose([mine[n][1] for n in names], enumerated(predict, x[i], background), atol=1e-10)


def test_categorical_splits_and_single_leaves():
    stump = TS.Tree(0, [0, None, None], [None] * 3, [np.array([1.0, 4.0]), None, None], [1, -1, -1], [2, -1, -1], [0.0, 5.0, -1.0])
    x = np.array([[1.0], [2.0], [4.0]])
    assert stump.predict(x).tolist() == [5, -1, 5]
    leaf = TS.Tree(1, [None], [None], [None], [-1], [-1], [3.0])
    assert leaf.predict(x).tolist() == [3, 3, 3]


def test_empty_background_raises(spark):
    arr = spark.createDataFrame([("p", [1.0])], "product_id string, x array<double>")
    nodes = spark.createDataFrame([], "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, value double")
    with pytest.raises(ValueError, match="empty"):
        TS.tree_attributions(arr, arr.limit(0), nodes)


def test_linear_models_take_the_closed_form(spark):
    df, numeric = listings(spark, 60), ["a", "b", "c"]
    model = M.fit_model("Linear Regression", df, numeric)
    base = model.transform(df).agg(F.avg("prediction")).first()[0]
    sums = TS.shap_exact(model, df, df, numeric).groupBy("product_id").agg(F.sum("shap_value").alias("phi"))
    both = model.transform(df).select("product_id", "prediction").join(sums, "product_id")
    assert both.agg(F.max(F.abs(F.col("prediction") - base - F.col("phi")))).first()[0] < 1e-6


def test_units_of_any_size_say_what_leaves_say(monkeypatch):
    rng = np.random.default_rng(3)
    inner, n = 2**6 - 1, 2**7 - 1
    grown = lambda of: [of(i) if i < inner else None for i in range(n)]
    feature, threshold = grown(lambda i: int(rng.integers(0, 6))), grown(lambda i: float(rng.normal()))
    child = lambda j: [2 * i + j if i < inner else -1 for i in range(n)]
    tree = TS.Tree(0, feature, threshold, [None] * n, child(1), child(2), [float(i) for i in range(n)])
    x = rng.normal(size=(400, 6))
    found = []
    for bits in (12, 4, 0):
        monkeypatch.setattr(TS, "UNIT_BITS", bits)
        units = [(u, c) for u, c in tree.units(x)]
        assert all(u.bits <= bits or not u.nodes for u, _ in units)
        patterns = {node: (v, f, p.tolist()) for u, c in units for node, v, f, p in tree.unit_leaves(u, c)}
        assert patterns == {node: (v, f, p.tolist()) for node, v, f, p in tree.leaves(x)}
        found.append(len(units))
    assert found[0] < found[1] < found[2] == inner + 1


def test_rows_of_one_product_stay_apart_over_blocks(spark):
    stump = lambda t: [(t, 0, 0, 0.5, None, 1, 2, 0.0), (t, 1, None, None, None, -1, -1, 1.0), (t, 2, None, None, None, -1, -1, 3.0)]
    nodes = spark.createDataFrame(
        stump(0) + stump(1), "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, value double"
    )
    arr = spark.createDataFrame([("p", [1.0]), ("p", [1.0]), ("q", [0.0])], "product_id string, x array<double>")
    found = TS.tree_attributions(arr, arr, nodes, block_nodes=1)
    values = sorted((r.product_id, round(r.shap[0], 9)) for r in found.collect())
    assert values == [("p", round(4 / 3, 9)), ("p", round(4 / 3, 9)), ("q", round(-8 / 3, 9))]


def test_sampled_values_move_no_hybrids(spark, monkeypatch):
    """Scored in the tasks they are what the model's own transform gives."""
    monkeypatch.setattr(M, "N_TREES", 4)
    monkeypatch.setattr(M, "N_ROUNDS", 4)
    df, numeric = listings(spark, 90), ["a", "b", "c"]
    train = df.where("product_id < 'p5'")
    twice = df.unionByName(df.where("product_id = 'p3'"))
    for name in M.MODEL_NAMES:
        model = M.fit_model(name, train, numeric, **({} if name.startswith("Linear") else {"max_depth": 6}))
        found = X.shap_sampled(model, twice, train, numeric, n_perm=3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "hashpartitioning" not in plan
        with monkeypatch.context() as m:
            m.setattr(X, "_scorer", lambda *_: None)
            scored = X.shap_sampled(model, twice, train, numeric, n_perm=3)
            keyed = lambda d: {(r.product_id, r.feature): (r.feature_value, r.shap_value, r.std_error) for r in d.collect()}
            mine, own = keyed(found), keyed(scored)
        assert mine.keys() == own.keys() and len(own) == 90 * 6
        assert np.allclose([mine[q] for q in own], list(own.values()), atol=1e-9)
