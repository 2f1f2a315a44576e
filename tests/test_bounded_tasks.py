"""Work of one task that must not grow with the table."""

from pyspark.sql import functions as F

from trustlens.operators import explain as X
from trustlens.plans import pipeline as PL
from trustlens.sources import fixtures as FX
from trustlens.sources import io as IO
from trustlens.sources import split_csv as SC

from conftest import SF001


def test_listing_files_are_bounded_by_their_text(spark, tmp_path):
    rows = [(i, f"p{i}", "x" * (i % 50) + ("\n\"q\", " if i % 7 == 0 else "")) for i in range(2000)]
    df = spark.createDataFrame(rows, "ordinal long, product_id string, review_content string").repartition(3)
    ranged = IO.in_files(df, "ordinal", file_bytes=8_000)
    assert ranged.rdd.getNumPartitions() > 5 and IO.in_files(df, "ordinal").rdd.getNumPartitions() == 1
    path = IO.write_csv(ranged.drop("ordinal"), str(tmp_path / "files"), bom=True)
    assert max(f.stat().st_size for f in (tmp_path / "files").glob("*.csv")) < 24_000
    for read in (IO.read_listings, SC.read_split_csv):
        got = sorted((r.ordinal, r.product_id, r.review_content or "") for r in read(spark, path).collect())
        assert got == [tuple(r) for r in rows]


def test_products_are_brought_together_in_bounded_parts(spark):
    arr = spark.createDataFrame([(f"p{i}", [float(i), 1.0]) for i in range(4000)], "product_id string, x array<double>")
    parts = X.by_product(arr, products=100)
    assert parts.rdd.getNumPartitions() == 40
    long = X.linear_attributions(parts, ["a", "b"], [1.0, 2.0], [0.0, 0.0])
    wide = X.shap_wide(long, ["a", "b"])
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1
    assert sorted(wide.collect()) == sorted((f"p{i}", float(i), 1.0, float(i), 2.0) for i in range(4000))


def test_rows_keep_what_the_tables_show(spark):
    rows = [(f"p{i // 2}", [float(i % 5), 1.0, 0.5, 2.0], [(-1.0) ** i * (i % 3), 0.5, -0.5, 0.0]) for i in range(60)]
    arr = spark.createDataFrame(rows, "product_id string, x array<double>, s array<double>")
    names, whole = ["d", "b", "c", "a"], None
    whole = X._long(arr, names, "s")
    top = lambda df: sorted(X.top_contributions(df, 3).collect())
    few = X._long(arr, names, "s", lambda e: X.largest(e, 3))
    assert few.count() == 180 and top(few) == top(whole)
    prof = spark.createDataFrame([(f"p{i}", "n", "c", 4.0, 1.0, 4.0) for i in range(30)], "product_id string, product_name string, main_category string, rating double, rating_count double, bayesian_rating double")
    kept = X._long(arr, names, "s", X.extremes)
    assert kept.count() == 120
    assert sorted(X.product_explain(prof, kept).collect()) == sorted(X.product_explain(prof, whole).collect())


def test_narrow_tables_never_move_the_review(spark):
    raw = FX.products_raw(spark, SF001, text=False)
    assert "review_content" not in raw.columns
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "length(text" in plan.split("Scan")[-2] + plan.split("Scan")[-1] + plan
    narrow = PL.narrow_clean(spark, SF001, 8)
    assert sorted(narrow.collect()) == sorted(PL.clean_table(spark, SF001, 8).drop("review_content").select(*narrow.columns).collect())


def test_the_split_is_written_once(spark):
    mi = PL.model_inputs(spark, SF001, 8)
    assert mi.split is mi.split
    plan = mi.split._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and mi.split.count() == mi.ready.count() == mi.split.where(F.col("split").isNotNull()).count()
