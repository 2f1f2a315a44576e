"""Refreshed gold tables against tables built anew."""

import os
import random

import pytest

from trustlens.operators import gold as G

RAW = "ordinal long, product_id string, product_name string, category string, discounted_price string, actual_price string, discount_percentage string, rating string, rating_count string, review_content string"


def listing(rng, ordinal, pid=None, category=None):
    pid = f"p{rng.randint(0, 150)}" if pid is None else pid
    category = rng.choice(["big", "big", "big", "mid", "small", "rare", "", "a/b=c"]) if category is None else category
    level = f"top|{category}|leaf" if category else rng.choice(["top", None, "top||leaf"])
    rating = rng.choice(["4.5", "3.9", "4", "|", "2.1", "5.7"])
    return (ordinal, pid, f"name {ordinal}", level, "₹1,000", "₹2,000", "50%", rating, rng.choice(["1,204", "17", None, "350", str(rng.randint(1, 900))]), rng.choice(["text", None]))


def tables(spark, root, version=None):
    rated = {tuple(r) for r in G.gold_table(spark, root, "rated", version).select("product_id", "main_category", "rating_count", "bayesian_rating", "is_suspicious", "ordinal").collect()}
    values = {tuple(r) for r in G.gold_table(spark, root, "values", version).collect()}
    listings = {tuple(r) for r in G.gold_table(spark, root, "listings", version).select("product_id", "second_category", "review_content", "ordinal").collect()}
    params = {tuple(r) for r in G.gold_table(spark, root, "params", version).collect()}
    return rated, values, listings, params


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_equals_rebuilt(spark, tmp_path, seed):
    rng = random.Random(seed)
    raw = [listing(rng, i) for i in range(120)]
    root = G.build_gold(spark.createDataFrame(raw, RAW), str(tmp_path / "gold"), 8)
    first = tables(spark, root)
    for step in range(3):
        out = {f"p{rng.randint(0, 170)}" for _ in range((0, 25, 6)[step])}
        # ordinals before and after those that are there
        more = [listing(rng, rng.choice([-1, 1]) * (1000 * (step + 1) + i)) for i in range((30, 0, 40)[step])]
        G.refresh_gold(
            spark,
            root,
            spark.createDataFrame(more, RAW) if more else None,
            spark.createDataFrame([(x,) for x in [*out, None]], "product_id string") if out else None,
            8,
        )
        raw = [r for r in raw if r[1] not in out] + more
        again = G.build_gold(spark.createDataFrame(raw, RAW), str(tmp_path / f"again{step}"), 8)
        assert tables(spark, root) == tables(spark, again)
    assert tables(spark, root, 0) == first  # an older version is still there


def test_only_what_changed_is_written(spark, tmp_path):
    rng = random.Random(7)
    row = lambda i, category, rating="4", count="10": (i, f"q{i}", "n", f"t|{category}|x", "₹1", "₹2", "5%", rating, count, "r")
    raw = [row(i, ("one", "two", "three")[i % 3]) for i in range(60)]
    root = G.build_gold(spark.createDataFrame(raw, RAW), str(tmp_path / "g"), 5)
    files = lambda v: sorted(d for d in os.listdir(f"{root}/rated/v={v}") if d.startswith("folder"))
    # a row like the others changes neither m nor C: it is appended
    change = G.refresh_gold(spark, root, spark.createDataFrame([row(100, "one")], RAW), None, 5)
    assert [tuple(r) for r in change.collect()] == [("one", "appended")]
    assert files(1) == ["folder=cone"]
    # another rating changes C; the other categories' folders are not written
    change = G.refresh_gold(spark, root, spark.createDataFrame([row(101, "two", "1", "900")], RAW), None, 5)
    assert [tuple(r) for r in change.collect()] == [("two", "rewritten")]
    assert files(2) == ["folder=ctwo"]
    live = {tuple(r) for r in spark.read.parquet(f"{root}/live/v=2").collect()}
    assert live == {("one", 0), ("one", 1), ("two", 2), ("three", 0)}
    # a category that falls below the bar moves to Other; one without rows goes
    out = spark.createDataFrame([(f"q{i}",) for i in range(60) if i % 3 == 2 and i > 10], "product_id string")
    change = {tuple(r) for r in G.refresh_gold(spark, root, None, out, 5).collect()}
    assert change == {("three", "emptied"), ("Other", "rewritten")}
    assert G.gold_table(spark, root, "rated").where("main_category = 'Other'").count() == 3
    assert G.gold_table(spark, root, "rated").count() == 45
    # nothing to do is a version like the last one
    assert G.refresh_gold(spark, root, None, None, 5).collect() == []
    assert tables(spark, root) == tables(spark, root, 3)


def test_a_refresh_cut_off_is_written_over(spark, tmp_path):
    rng = random.Random(9)
    root = G.build_gold(spark.createDataFrame([listing(rng, i) for i in range(50)], RAW), str(tmp_path / "g"), 4)
    before = tables(spark, root)
    spark.createDataFrame([("p1",)], "product_id string").write.parquet(f"{root}/removed/v=1")  # and no further
    assert tables(spark, root) == before
    G.refresh_gold(spark, root, None, None, 4)
    assert tables(spark, root) == before
