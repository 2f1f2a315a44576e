"""Merged sketches against exact values; lookups that read few row groups."""

import random

import pytest
from pyspark.sql import functions as F

from trustlens.operators import sketches as SK
from trustlens.sources import keyed as K


@pytest.fixture(scope="module")
def products(spark):
    rng = random.Random(3)
    rows = []
    for i in range(30_000):
        c = rng.choice(["big"] * 8 + ["mid", "small"])
        rows.append((f"p{i % 25_000:06d}", c, float(int(rng.lognormvariate(5, 2))) if i % 50 else None))
    rows += [("lone", "one", None), ("p000001", "two", 5.0)]
    return spark.createDataFrame(rows, "product_id string, main_category string, rating_count double")


def test_merged_quantiles_are_within_the_bound(spark, products, tmp_path):
    paths = []
    for b in range(4):  # written batch by batch, read and merged later
        paths.append(str(tmp_path / str(b)))
        SK.category_sketches(products.where(F.pmod(F.xxhash64("product_id"), F.lit(4)) == b)).write.parquet(paths[-1])
    merged = SK.merge_sketches(*(spark.read.parquet(p) for p in paths))
    qs, names = [0.0, 0.2, 0.25, 0.5, 0.8, 1.0], ["a", "b", "c", "d", "e", "f"]
    got = {r.main_category: r for r in SK.sketch_quantiles(merged, qs, names).collect()}
    exact = {}
    for r in products.where("rating_count is not null").collect():
        exact.setdefault(r.main_category, []).append(r.rating_count)
    for c, values in exact.items():
        assert got[c].n == len(values)
        for q, name in zip(qs, names):
            v = got[c][name]
            low, high = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
            assert low - 2 * SK.rank_error() <= q <= high + 2 * SK.rank_error()
    assert got["one"].n == 0 and got["one"].d is None and got["two"].d == 5


def test_distinct_counts_of_any_set(spark, products):
    halves = [SK.category_sketches(products.where(F.pmod(F.hash("product_id"), F.lit(3)) == b)) for b in range(3)]
    merged = SK.merge_sketches(*halves)
    for some in (None, ["big"], ["mid", "small"], ["one", "two"]):
        rows = products if some is None else products.where(F.col("main_category").isin(some))
        want = rows.agg(F.countDistinct("product_id")).first()[0]
        assert SK.distinct_products(merged, some).first()[0] == pytest.approx(want, rel=SK.distinct_error())
    assert SK.distinct_products(merged, ["nothing"]).first()[0] == 0
    assert {r.main_category for r in SK.distinct_per_category(merged).collect()} == {"big", "mid", "small", "one", "two"}


def scanned_rows(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_lookups_read_few_rows(spark, products, tmp_path):
    wide = products.withColumn("payload", F.sha2(F.col("product_id"), 512))
    path = K.write_keyed(wide, str(tmp_path / "t"), row_group_bytes=64 << 10)
    ids = spark.createDataFrame([("p000123",), ("p024999",), ("lone",), ("nowhere",), (None,)], "product_id string")
    found = K.lookup_products(spark, path, ids)
    want = products.join(ids, "product_id", "left_semi").count()
    assert found.count() == want
    assert scanned_rows(K.lookup_products(spark, path, ids)) < products.count() / 3
    absent = ids.where("product_id = 'nowhere'")
    assert scanned_rows(K.lookup_products(spark, path, absent)) < products.count() / 20
    one = K.lookup_category(spark, path, "small")
    assert one.count() == products.where("main_category = 'small'").count()
    assert scanned_rows(K.lookup_category(spark, path, "small")) < products.count() / 3
    assert K.lookup_products(spark, path, ids.limit(0)).count() == 0


def test_many_keys_are_joined(spark, products, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "NAMED_KEYS", 2)
    path = K.write_keyed(products, str(tmp_path / "t"))
    ids = products.where("product_id like '%00'").select("product_id")
    assert K.lookup_products(spark, path, ids).count() == products.where("product_id like '%00'").count()
