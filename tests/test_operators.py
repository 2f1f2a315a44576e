import pytest
from pyspark.sql import functions as F

from trustlens.functions.ranking import global_row_number
from trustlens.operators import clean as C
from trustlens.operators import guide as G
from trustlens.operators import trust as T

# A few rows transcribed from the reference's published rank-movers output:
# (rating, count, m, C) -> (adjusted rating, gap)
GOLDEN = [
    (4.6, 9.0, 248.2, 3.9905, 4.0118, 0.5882),
    (4.5, 38.0, 4497.2, 4.0081, 4.0122, 0.4878),
    (4.8, 28.0, 623.5, 4.0534, 4.0855, 0.7145),
    (4.5, 11.0, 248.2, 3.9905, 4.0121, 0.4879),
]


def test_gated_rating_golden_rows(spark):
    df = spark.createDataFrame(
        [r[:4] for r in GOLDEN], "rating double, rating_count double, m_value double, category_mean_rating double"
    )
    got = [r["b"] for r in df.select(T.gated_rating().alias("b")).collect()]
    assert got == [g[4] for g in GOLDEN]
    assert [round(g[0] - g[4], 4) for g in GOLDEN] == [g[5] for g in GOLDEN]


def test_gated_rating_edges(spark):
    df = spark.createDataFrame(
        [(4.0, 10.0, 10.0, 3.0), (4.0, 0.0, 10.0, 3.0), (4.0, 5.0, 0.0, 3.0), (5.0, 1.0, 3.0, 2.0)],
        "rating double, rating_count double, m_value double, category_mean_rating double",
    )
    got = [r[0] for r in df.select(T.gated_rating()).collect()]
    assert got[0] == 4.0  # v = m: reliable, keeps R
    assert got[1] == 3.0  # v = 0: pulled fully to C
    assert got[2] == 4.0  # m = 0: v >= m
    assert 2.0 <= got[3] <= 5.0  # between C and R


def test_ungated_rating_zero_over_zero_is_null(spark):
    cands = spark.createDataFrame([(1, "a", 4.0, 0), (2, "a", 4.0, 10)], "candidate_id long, category string, rating double, review_count long")
    params = spark.createDataFrame([("a", 0.0, 3.0, 3.0)], "main_category string, m_value double, category_mean_rating double, category_mean_exact double")
    got = {r["candidate_id"]: r for r in G.score_candidates(cands, params).collect()}
    assert got[1]["corrected_rating"] is None and got[1]["level"] is None
    assert got[2]["corrected_rating"] == 4.0 and got[2]["level"] == "success"


def test_verdict_tiers(spark):
    cands = spark.createDataFrame(
        [(1, "a", 4.0, 1000), (2, "a", 4.0, 100), (3, "a", 5.0, 0)],
        "candidate_id long, category string, rating double, review_count long",
    )
    params = spark.createDataFrame([("a", 100.0, 3.0, 3.0)], "main_category string, m_value double, category_mean_rating double, category_mean_exact double")
    got = {r["candidate_id"]: r["level"] for r in G.score_candidates(cands, params).collect()}
    # declines: 1000/1100 -> 0.0909; 100/200 -> 0.5; 0 -> 2.0
    assert got == {1: "success", 2: "error", 3: "error"}


@pytest.mark.parametrize("parts", [3, 8, 17])
def test_global_row_number_equals_window_under_skew(spark, parts):
    # a third of all rows share one value: the unique tie-break spreads them
    rows = [(i, 7.0 if i % 3 == 0 else float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "ordinal long, v double")
    got = global_row_number(df, [F.desc("v"), F.asc("ordinal")], "rk", num_partitions=parts, total_col="n")
    pdf = got.toPandas().sort_values("ordinal")
    exp = df.toPandas()
    ranks = dict(zip(exp.sort_values(["v", "ordinal"], ascending=[False, True])["ordinal"], range(1, 3001)))
    assert [ranks[o] for o in pdf["ordinal"]] == pdf["rk"].tolist()
    assert set(pdf["n"]) == {3000}


def test_dedup_first_keeps_smallest_ordinal_with_hot_key(spark):
    rows = [("hot" if i % 3 == 0 else f"p{i}", i, f"name{i}") for i in range(900, 0, -1)]
    df = spark.createDataFrame(rows, "product_id string, ordinal long, product_name string")
    got = {r["product_id"]: r for r in C.dedup_first(df).collect()}
    assert got["hot"]["ordinal"] == 3 and got["hot"]["product_name"] == "name3"
    assert len(got) == 1 + 600


def test_bucket_rare_and_domain(spark):
    rows = [(str(i), "A" if i < 20 else ("B" if i < 25 else None), i) for i in range(30)]
    df = spark.createDataFrame(rows, "product_id string, second_category string, ordinal long")
    out = {r["product_id"]: r["main_category"] for r in C.bucket_rare(df, min_products=15).collect()}
    assert out["0"] == "A" and out["21"] == "Other" and out["29"] == "Other"


def test_seed_domain_first_rows_get_every_category(spark):
    clean = spark.createDataFrame(
        [("A",)] * 3 + [("B",)] * 2 + [("Other",)], "main_category string"
    )
    allowed = C.allowed_categories(clean)
    assert [r["main_category"] for r in allowed.orderBy("position").collect()] == ["A", "B", "Other"]
    dummy = spark.createDataFrame(
        [(i, str(i), "x", lab) for i, lab in enumerate(["others", "Zzz", "A", "Others", "B"])],
        "ordinal long, product_id string, product_name string, main_category string",
    )
    seeded = C.conformed_dummy(dummy, clean)
    got = [r["main_category"] for r in seeded.orderBy("ordinal").collect()]
    assert got == ["A", "B", "Other", "Other", "B"]
    check = C.domain_check(clean.withColumn("product_id", F.lit("x")), seeded)
    assert all(r["category_match"] for r in check.collect())
