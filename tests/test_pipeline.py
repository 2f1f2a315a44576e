import math
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from trustlens.operators import explain as X
from trustlens.operators import model as M
from trustlens.operators import trust as T
from trustlens.plans import pipeline as PL
from trustlens.streaming.guide_stream import score_stream
from trustlens.sources import fixtures as FX

from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 50
    assert "rank_change" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.mark.parametrize(
    "name",
    ["clean_products", "category_params", "trust_detail", "rank_movers_top50", "histogram15",
     "quintile_summary", "score_candidates", "feature_table", "seed_domain", "split_assign"],
)
def test_oracle_agrees_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    s = E.queries()[name](spark, SF001).toPandas()
    d = con.execute(E.oracle_sql()[name]).fetchdf()
    cols = sorted(s.columns)
    assert cols == sorted(d.columns)
    key = lambda row: tuple((x is None, str(x)) for x in row)
    srows = sorted([tuple(_norm(v) for v in r) for r in s[cols].itertuples(index=False)], key=key)
    drows = sorted([tuple(_norm(v) for v in r) for r in d[cols].itertuples(index=False)], key=key)
    assert srows == drows


def _difference(sampled, exact):
    j = sampled.alias("a").join(exact.alias("b"), ["product_id", "feature"])
    row = j.agg(F.count(F.lit(1)), F.max(F.abs(F.col("a.shap_value") - F.col("b.shap_value")))).first()
    assert row[0] == exact.count() == sampled.count()
    return row[1]


def test_sampled_shapley_on_linear_model_is_exact(spark):
    # the background is the whole training set, so both must agree on it
    mi = PL.model_inputs(spark, SF001, 8)
    train = mi.split.where("split = 'train'")
    model = M.fit_model("Linear Regression", train, mi.numeric)
    sampled = X.shap_sampled(model, mi.ready, train, mi.numeric, n_perm=2)
    assert _difference(sampled, X.shap_linear(model, mi.ready, train, mi.numeric)) < 1e-6
    assert sampled.agg(F.max("std_error")).first()[0] < 1e-9
    mean = X.background_mean(X.background_summary(model, train))
    exact = X.feature_means(X.feature_arrays(model, train), len(mean))
    assert max(abs(x - y) for x, y in zip(mean, exact)) < 1e-8


def test_sampled_shapley_additivity_forest(spark):
    mi = PL.model_inputs(spark, SF001, 8)
    train = mi.split.where("split = 'train'")
    model = M.fit_model("Random Forest", train, mi.numeric, max_depth=4)
    shap = X.shap_sampled(model, mi.ready, train, mi.numeric, n_perm=2)
    total = shap.groupBy("product_id").agg(F.sum("shap_value").alias("phi"))
    pred = model.transform(mi.ready).select("product_id", "prediction")
    background = X.background_summary(model, train)
    from pyspark.ml.functions import array_to_vector

    bgdf = spark.createDataFrame(background, "x array<double>, n long").withColumn("features", array_to_vector("x"))
    at = model.stages[-1].transform(bgdf)
    base = at.agg(F.sum(F.col("prediction") * F.col("n")) / F.sum("n")).first()[0]
    err = total.join(pred, "product_id").agg(F.max(F.abs(F.col("phi") - (F.col("prediction") - F.lit(base))))).first()[0]
    assert err < 1e-9


def test_boosted_trees_fit_and_settings_reach_the_learner(spark):
    mi = PL.model_inputs(spark, SF001, 8)
    train = mi.split.where("split = 'train'")
    stage = M.make_regressor("Gradient Boosting", max_depth=3, max_bins=16)
    assert (stage.getMaxDepth(), stage.getMaxBins()) == (3, 16)
    assert M.make_regressor("Random Forest").getMaxDepth() == M.FOREST_DEPTH
    stage.setMaxIter(5)
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=M.feature_stages(mi.numeric) + [stage]).fit(M.sized_for_training(train))
    row = fitted.transform(train).agg(F.avg((F.col("prediction") - F.col(M.TARGET)) ** 2), F.var_pop(M.TARGET)).first()
    assert row[0] < row[1]
    many = M.sized_for_training(spark.range(100_000))
    assert many.rdd.getNumPartitions() == min(100, spark.sparkContext.defaultParallelism)
    many.unpersist()


def test_models_fitted_together_are_those_fitted_alone(spark, monkeypatch):
    monkeypatch.setattr(M, "N_TREES", 3)
    monkeypatch.setattr(M, "N_ROUNDS", 3)
    mi = PL.model_inputs(spark, SF001, 8)
    train = mi.split.where("split = 'train'")
    settings = {"Gradient Boosting": {"max_depth": 3}, "Linear Regression": {}, "Random Forest": {"max_depth": 4}}
    sized, cached = M.sized_for_training, []
    monkeypatch.setattr(M, "sized_for_training", lambda t: cached.append(sized(t)) or cached[-1])
    together = M.fit_models(settings, train, mi.numeric)
    assert list(together) == list(settings) and len(cached) == 1 and not cached[0].is_cached
    for name, own in settings.items():
        both = [m.transform(mi.split).orderBy("product_id").select("prediction").collect() for m in (together[name], M.fit_model(name, train, mi.numeric, **own))]
        assert both[0] and all(abs(a.prediction - b.prediction) < 1e-9 for a, b in zip(*both)), name


def test_forest_in_short_passes_is_the_same_forest(spark, monkeypatch):
    # 8 levels of 200 trees were held at once: up to 512 MB in every task
    assert M.make_regressor("Random Forest", max_depth=8).getMaxMemoryInMB() <= 4
    assert M.make_regressor("Random Forest").getMaxMemoryInMB() == M.make_regressor("Gradient Boosting").getMaxMemoryInMB() == 512
    monkeypatch.setattr(M, "N_TREES", 12)
    i = F.col("id")
    # whole numbers, whose sums do not depend on their order
    train = spark.range(3000).select(
        (i * 37 % 1009).cast("double").alias("a"), (i * 101 % 613).cast("double").alias("b"),
        F.concat(F.lit("c"), (i % 40).cast("string")).alias("main_category"),
        (i * i % 97 + i * 37 % 1009 % 50).cast("double").alias(M.TARGET),
    )
    jobs, found = spark.sparkContext.statusTracker(), {}
    for mb in (1, 512):
        monkeypatch.setattr(M, "forest_node_mb", lambda depth, mb=mb: mb)
        spark.sparkContext.setJobGroup(f"forest-{mb}", "")
        model = M.fit_model("Random Forest", train, ["a", "b"], max_depth=8)
        trees = model.stages[-1]
        found[mb] = trees.toDebugString, len(jobs.getJobIdsForGroup(f"forest-{mb}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    drop_name = lambda text: text.split("\n", 1)[1]
    assert drop_name(found[1][0]) == drop_name(found[512][0])
    assert found[1][1] > found[512][1]


def test_unseen_category_is_all_zeros(spark):
    mi = PL.model_inputs(spark, SF001, 8)
    model = M.fit_model("Linear Regression", mi.split.where("split = 'train'"), mi.numeric)
    odd = mi.ready.limit(1).withColumn("main_category", F.lit("never seen"))
    x = X.feature_arrays(model, odd).first()["x"]
    assert len(x) == len(X.feature_names(model, mi.numeric)) and sum(x[len(mi.numeric):]) == 0


def test_saved_model_keeps_its_split(spark):
    mi = PL.model_inputs(spark, SF001, 8)
    model = M.fit_model("Linear Regression", mi.split.where("split = 'train'"), mi.numeric)
    path = M.save_model(model, tempfile.mkdtemp(prefix="tl-model-") + "/m", mi.split)
    again = M.load_split(spark, path)
    assert sorted(again.select("product_id", "split").collect()) == sorted(mi.split.select("product_id", "split").collect())
    assert M.load_model(path).stages[0].labels == model.stages[0].labels


def test_metrics_of_a_constant_target_and_of_nothing(spark):
    rows = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "bayesian_rating double, prediction double")
    assert tuple(M.evaluate(rows).first()) == (0.5, 0.5, None)
    assert tuple(M.evaluate(rows.limit(0)).first()) == (None, None, None)
    detail = T.trust_detail(PL.clean_table(spark, SF001, 8)).limit(0)
    assert T.trust_summary(detail).first()["suspicious_pct"] is None


def test_wide_export_goes_back_to_long(spark):
    long = spark.createDataFrame(
        [("p", "a", 1.0, 0.5), ("p", "b", 2.0, -0.5), ("q", "a", 3.0, 0.25), ("q", "b", 4.0, 0.0)],
        "product_id string, feature string, feature_value double, shap_value double",
    )
    assert sorted(X.shap_long(X.shap_wide(long, ["a", "b"])).collect()) == sorted(long.collect())


def test_wide_export_has_every_feature(spark, tmp_path):
    brands = ["a brand", "b.brand", "c & d"]
    parts = [(i, f"part {i}", brands[i % 3], "TYPE", 5, 900.0 + i) for i in range(150)]
    parts += [(i, f"part {i}", "rare", "TYPE", 5, 900.0 + i) for i in range(150, 160)]
    lines = [(i, float(1 + (i * 7 + j) % 50), (i + j) % 11 / 100) for i in range(160) for j in range(1 + i % 3)]
    tables = {
        "part": (parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "lineitem": (lines, "l_partkey long, l_quantity double, l_discount double"),
        "documents": ([(i, "x" * (i * i % 301)) for i in range(60)], "doc_id long, text string"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    queries = E.queries()
    names = {r.feature: r.feature_index for r in queries["feature_names"](spark, str(tmp_path)).collect()}
    assert [n for n in names if n.startswith("cat__")] == [f"cat__main_category_{b}" for b in ["Other", *brands]]
    wide = queries["shap_wide"](spark, str(tmp_path))
    cells = [f"{kind}_{i}" for kind in ("value", "shap") for i in range(len(names))]
    assert wide.columns == ["product_id", *cells]
    found = {r.product_id: r for r in wide.collect()}
    long = queries["shap_linear"](spark, str(tmp_path)).collect()
    assert len(found) > 100 and len(long) == len(found) * len(names)
    for r in long:
        i = names[r.feature]
        assert (found[r.product_id][f"value_{i}"], found[r.product_id][f"shap_{i}"]) == (r.feature_value, r.shap_value)
    twin = con.execute(E.oracle_sql()["shap_wide"]).fetchdf()
    assert sorted(twin.columns) == sorted(wide.columns)
    assert sorted(map(tuple, found.values())) == sorted(twin[wide.columns].itertuples(index=False, name=None))


def test_streaming_scorer_matches_batch(spark):
    clean = PL.clean_table(spark, SF001, 8)
    params = T.category_params(clean)
    cands = FX.candidates(clean)
    root = tempfile.mkdtemp(prefix="tl-stream-")
    src = f"{root}/in"
    cands.repartition(3).write.parquet(src)
    q = score_stream(spark, src, params, f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{root}/out")
    from trustlens.operators.guide import score_candidates

    batch = score_candidates(cands, params)
    cols = ["candidate_id", "corrected_rating", "level"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())
