"""What the plans must look like: no wide shuffle, no hot key, nothing kept."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from trustlens.functions import joins
from trustlens.functions.ranking import global_row_number, running_total
from trustlens.operators import clean as C
from trustlens.operators import trust as T
from trustlens.plans import pipeline as PL

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_static_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _hot(spark, n=3000):
    rows = [(str(i), f"n{i}", "hot" if i % 3 == 0 else f"c{i % 20}", float(i % 50), 4.0, i) for i in range(n)]
    return spark.createDataFrame(
        rows, "product_id string, product_name string, main_category string, rating_count double, rating double, ordinal long"
    )


def test_lookup_joins_do_not_move_the_rows(spark, no_static_broadcast):
    for df in (T.trust_detail(_hot(spark)), C.bucket_rare(_hot(spark).withColumnRenamed("main_category", "second_category"))):
        plan = _plan(df)[1]
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_large_lookups_are_salted(spark, no_static_broadcast, monkeypatch):
    big = _hot(spark)
    small = big.groupBy("main_category").agg(F.count(F.lit(1)).alias("n"))
    expected = sorted(joins.lookup_join(big, small, "main_category").collect())
    got = joins.lookup_join(big, small, "main_category", broadcast_rows=3, salts=8)
    assert "_tl_salt" in _plan(got)[1] and "Broadcast" not in _plan(got)[1]
    assert sorted(got.collect()) == expected and got.columns == joins.lookup_join(big, small, "main_category").columns
    sizes = big.withColumn("s", F.pmod(F.xxhash64(*big.columns), F.lit(8))).where("main_category = 'hot'").groupBy("s").count()
    assert sizes.agg(F.max("count")).first()[0] < 300  # of 1,000 rows of the hot key


@pytest.mark.parametrize("name", ["dedup_first", "kpis", "skew_report"])
def test_review_text_is_not_read_where_it_is_not_needed(spark, name):
    df = E.queries()[name](spark, SF001)
    logical, physical = _plan(df)
    if name == "skew_report":  # needs its length
        assert "Exchange" not in physical or "review_content" not in physical.split("Exchange", 1)[0]
    else:
        assert "review_content" not in physical
    assert "SortAggregate" not in physical


def test_parameters_scan_no_text(spark):
    clean = PL.clean_table(spark, SF001, 8)
    per_value = clean.groupBy("main_category", "rating_count").agg(F.sum("rating"))
    assert "review_content" not in _plan(per_value)[1]


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    for name in ("category_params", "rank_movers_top50", "fit_linear"):
        E.queries()[name](spark, SF001).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_ranks_do_not_depend_on_the_partition_count(spark):
    detail = T.trust_detail(PL.clean_table(spark, SF001, 8))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(T.rank_movers_top(detail, 50).collect())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == 50


def test_running_total_equals_the_plain_one(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", float(i), i % 4) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r.g, r.v): r.t for r in running_total(df, ["g", "v"], "n", "t").collect()}
    total = 0
    for g, v, n in sorted(rows):
        total += n
        assert got[g, v] == total
    assert global_row_number(df.limit(0), [F.col("v")], "r").count() == 0
