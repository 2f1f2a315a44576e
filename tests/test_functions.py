import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trustlens.functions import scalar as S
from trustlens.functions.stats import histogram_bin, widened_range


def test_round_even_matches_published_m_values(spark):
    # Q1 values of integer counts are multiples of .25; the published m values
    # are rounded half to even: 248.25 -> 248.2, 404.75 -> 404.8, 4497.25 -> 4497.2
    df = spark.createDataFrame([(248.25,), (404.75,), (4497.25,), (2625.75,)], "x double")
    got = [r[0] for r in df.select(S.round_even("x", 1)).collect()]
    assert got == [248.2, 404.8, 4497.2, 2625.8]


def test_round_even_equals_numpy_on_ties(spark):
    vals = [k / 20000.0 for k in range(1, 4000, 7)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(S.round_even("x", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in vals]


def test_quintile_formula_equals_qcut(spark):
    # every n from 6 to 399 in one job
    rows = [(n, r) for n in range(6, 400) for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n long, r long")
    got = df.select("n", "r", S.quintile_of_rank(F.col("r"), F.col("n")).alias("q")).toPandas()
    for n, grp in got.groupby("n"):
        grp = grp.sort_values("r")
        expected = pd.qcut(grp["r"].astype(float), q=5, labels=False).tolist()
        assert (grp["q"] - 1).tolist() == expected, n


def test_quintile_n7_sizes(spark):
    df = spark.createDataFrame([(r,) for r in range(1, 8)], "r long")
    q = df.select(S.quintile_of_rank(F.col("r"), F.lit(7)).alias("q")).groupBy("q").count().orderBy("q")
    assert [r["count"] for r in q.collect()] == [2, 1, 1, 1, 2]


def test_adjusted_skew_equals_pandas(spark):
    vals = [1.0, 2.0, 3.0, 10.0, 2.0, 1.0, 40.0, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(S.adjusted_skew("x")).first()[0]
    assert got == pytest.approx(pd.Series(vals).skew(), rel=1e-12)


def test_category_level_edges(spark):
    rows = [("A|B|C",), ("A| B |C",), ("OnlyOne",), (None,), ("A||C",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(S.category_level("c", 1)).collect()]
    assert got == ["B", "B", None, None, ""]


def test_parsers(spark):
    df = spark.createDataFrame(
        [("₹1,099.00", "64%", "24,269", "4.2"), ("₹x", "%", None, "|"), ("nan", "5", "12", "nan")],
        "p string, d string, c string, r string",
    )
    got = df.select(
        S.parse_money("p"), S.parse_percent("d"), S.parse_count("c"), S.parse_numeric("r")
    ).collect()
    assert tuple(got[0]) == (1099.0, 64.0, 24269.0, 4.2)
    assert tuple(got[1]) == (None, None, None, None)
    assert tuple(got[2]) == (None, 5.0, 12.0, None)  # text "nan" is missing, never NaN


def test_numbers_are_read_as_pandas_reads_them(spark):
    texts = ["4d", "4.5f", "0x1p3", "1e3", " 7 ", "\t8\u00a0", "+.5", "5.", "-2", "1_000", "1,000", "", "e5", ".", "--1", "inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(S.parse_numeric("t")).collect()]
    expected = [None if pd.isna(v) else float(v) for v in pd.to_numeric(pd.Series(texts), errors="coerce")]
    expected[texts.index("\t8\u00a0")] = 8.0
    assert got == expected


def test_category_level_loses_all_white_space(spark):
    df = spark.createDataFrame([("A|\tB\u00a0|C",), ("A|\u2003B\r\n",), ("A|B C",)], "c string")
    assert [r[0] for r in df.select(S.category_level("c", 1)).collect()] == ["B", "B", "B C"]


def test_review_length_counts_code_points(spark):
    df = spark.createDataFrame([("a😀b",), ("",)], "t string")
    assert [r[0] for r in df.select(F.length("t")).collect()] == [len("a😀b"), 0]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_histogram_bins_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.round(np.log10(rng.integers(0, 200000, size=500) + 1.0), 9)
    counts, edges = np.histogram(x, bins=15)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    mn, mx = df.agg(F.min("x"), F.max("x")).first()
    lo, hi = widened_range(F.lit(mn), F.lit(mx))
    got = (
        df.select(histogram_bin(F.col("x"), lo, hi, 15).alias("b")).groupBy("b").count().collect()
    )
    got_counts = [0] * 15
    for r in got:
        got_counts[r["b"]] = r["count"]
    assert got_counts == counts.tolist()


def test_histogram_single_value_goes_to_middle(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    lo, hi = widened_range(F.lit(2.0), F.lit(2.0))
    got = df.select(histogram_bin(F.col("x"), lo, hi, 15)).distinct().collect()
    counts, _ = np.histogram([2.0, 2.0], bins=15)
    assert [r[0] for r in got] == [int(np.argmax(counts))]


def test_quantiles_and_ranks_are_the_same_by_ranges(spark, monkeypatch):
    from trustlens.functions import ranking, stats

    rows = [(g, float(v)) for g in ("a", "b", None) for v in range(0, 50, 3 if g == "a" else 7)] + [("a", 3.0)] * 9
    df = spark.createDataFrame(rows, "g string, v double")
    both = []
    for small in (200_000, 0):
        monkeypatch.setattr(stats, "SMALL_VALUES", small)
        found = stats.group_quantiles(df.where("g is not null"), ["g"], "v", [0.0, 0.25, 0.5, 1.0], ["a", "b", "c", "d"])
        whole = stats.group_quantiles(df, [], "v", [0.2, 0.8], ["a", "b"])
        both.append((sorted(map(tuple, found.collect())), [tuple(r) for r in whole.collect()]))
    assert both[0] == both[1]
    orders = {"up": [F.col("v"), F.col("g").asc_nulls_first()], "down": [F.desc("v"), F.col("g").asc_nulls_first()]}
    some = df.distinct()
    assert sorted(map(str, ranking.row_numbers(some, orders).collect())) == sorted(map(str, ranking.row_numbers(some, orders, 0).collect()))
