import tempfile

import pytest
from pyspark.sql import functions as F

from trustlens.operators import profile as P
from trustlens.operators import trust as T
from trustlens.plans import pipeline as PL
from trustlens.sources import io as IO

from conftest import SF001


def test_read_listings_multiline_quotes_bom_and_padded_header(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    path = f"{d}/listings.csv"
    text = (
        "﻿ product_id , product_name,rating\n"
        'B01,"Kettle, 1.5 L ""steel""",4.2\n'
        'B02,"two\nlines",3.9\n'
    )
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    df = IO.read_listings(spark, path)
    assert df.columns[:3] == ["product_id", "product_name", "rating"]
    rows = df.orderBy("product_id").collect()
    assert rows[0]["product_name"] == 'Kettle, 1.5 L "steel"'
    assert rows[1]["product_name"] == "two\nlines"
    assert [r["ordinal"] for r in rows] == sorted(r["ordinal"] for r in rows)


def test_metrics_json_round_trip(spark):
    m = spark.createDataFrame([("a", 0.1, 0.2, 0.3), ("b", 0.4, 0.5, 0.6)], "model string, rmse double, mae double, r2 double")
    path = IO.write_metrics_json(m, tempfile.mkdtemp(prefix="tl-json-") + "/m")
    raw = spark.read.text(path).first()[0]
    assert raw.startswith("[") and raw.endswith("]")
    assert sorted(IO.read_metrics(spark, path).collect()) == sorted(m.collect())


def test_approximate_variants_stay_close(spark):
    clean = PL.clean_table(spark, SF001, 8)
    exact = P.kpis(clean).first()
    approx = P.kpis_approx(clean).first()
    assert abs(approx["distinct_products_approx"] - exact["distinct_products"]) <= 0.05 * exact["distinct_products"]
    q = T.m_values_approx(clean).join(T.category_quantile(clean, "rating_count", 0.25), "main_category")
    bounds = clean.groupBy("main_category").agg(F.min("rating_count").alias("lo"), F.max("rating_count").alias("hi"))
    for r in q.join(bounds, "main_category").collect():
        assert r["lo"] <= r["m_value_approx"] <= r["hi"]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_rows_of_several_files_are_numbered_by_path(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    _write(f"{d}/a.csv", "id,name\n1,x\n2,y\n")
    _write(f"{d}/b.csv", "id,name\n" + "".join(f"{i},{'long ' * 50}\n" for i in range(3, 60)))
    got = {r["id"]: r["ordinal"] for r in IO.read_listings(spark, d).collect()}
    assert got == {str(i): i - 1 for i in range(1, 60)}


def test_another_column_order_is_refused(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    _write(f"{d}/a.csv", "id,name\n1,x\n")
    _write(f"{d}/b.csv", "name,id\ny,2\n" * 1)
    with pytest.raises(Exception, match="(?i)header"):
        IO.read_listings(spark, d).collect()


def test_exchange_csv_with_a_byte_order_mark(spark):
    path = tempfile.mkdtemp(prefix="tl-csv-") + "/out"
    df = spark.createDataFrame([("1", " padded\t", 'a "b", c'), ("2", None, "x\ny")], "id string, name string, text string")
    IO.write_csv(df, path, single_file=True, bom=True)
    raw = spark.read.format("binaryFile").load(path + "/*.csv").first().content
    assert bytes(raw).startswith(b"\xef\xbb\xbfid,")
    assert sorted(tuple(r)[:3] for r in IO.read_listings(spark, path).collect()) == sorted(map(tuple, df.collect()))


def test_zip_archives_round_trip(spark):
    root = tempfile.mkdtemp(prefix="tl-zip-")
    df = spark.createDataFrame([(str(i), f"name {i}\nline") for i in range(40)], "id string, name string").repartition(3)
    archives = IO.zip_listings(df, root + "/zips")
    got = IO.read_listings(spark, IO.unzip_listings(spark, archives, root + "/csv"))
    assert sorted((r["id"], r["name"]) for r in got.collect()) == sorted(map(tuple, df.collect()))
    assert sorted(r["ordinal"] for r in got.collect()) == list(range(40))
    with pytest.raises(Exception, match="(?i)no item named"):
        IO.unzip_listings(spark, archives, root + "/none", "other.csv")
