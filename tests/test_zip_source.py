"""Zip members as rows."""

import csv
import io
import zipfile

import pytest

from trustlens.sources import zip_source as Z


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, rows in members.items():
            out = io.StringIO()
            csv.writer(out).writerows(rows)
            z.writestr(name, "﻿" + out.getvalue() if name.startswith("bom") else out.getvalue())


@pytest.fixture
def folder(tmp_path):
    long = "x" * 300_000
    archive(tmp_path / "a.zip", {
        "one.csv": [["id", " name ", "text"], *[[i, f"n{i}", f'line "{i}"\n,é'] for i in range(2500)]],
        "bom.csv": [["text", "id", "name"], ["t", "7000", ""], [long, "7001", "n"]],
        "notes.txt": [["not", "this"]],
        "empty.csv": [],
    })
    archive(tmp_path / "b.zip", {"sub/two.csv": [["id", "name", "text"], ["8000", "b", ""]]})
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "none.zip").write_bytes(b"")
    return tmp_path


def test_members_are_partitions_and_rows_whole(spark, folder):
    got = Z.read_zip_listings(spark, str(folder), ["id", "text", "name"], "[!e]*.csv")
    assert got.rdd.getNumPartitions() == 3
    rows = {r.id: (r.name, r.text) for r in got.collect()}
    assert len(rows) == 2503
    assert rows["12"] == ("n12", 'line "12"\n,é')
    assert rows["7000"] == (None, "t") and rows["7001"] == ("n", "x" * 300_000)
    assert rows["8000"] == ("b", None)


def test_columns_places_and_globs(spark, folder):
    got = Z.read_zip_listings(spark, f"{folder}/a*.zip", ["_row", "id", "_member"][1:], "one.csv")
    assert got.columns == ["id", "_member"] and got.count() == 2500
    spark.dataSource.register(Z.ZipListings)
    placed = spark.read.format("ziplistings").schema("id string, _row long, _archive string").option("path", f"file://{folder}/a.zip").option("members", "one.csv").load()
    assert [(r.id, r._row) for r in placed.orderBy("_row").limit(3).collect()] == [("0", 0), ("1", 1), ("2", 2)]
    assert placed.where("_row = 2400").first()._archive.endswith("a.zip")
    plain = spark.read.format("ziplistings").option("path", f"{folder}/b.zip").load()
    assert plain.columns == ["id", "name", "text"]


def test_what_is_not_there(spark, folder):
    assert Z.read_zip_listings(spark, str(folder), ["id"], "nothing*.csv").collect() == []
    for wrong in (lambda: Z.read_zip_listings(spark, str(folder), ["price"], "one.csv").collect(), lambda: Z.read_zip_listings(spark, f"{folder}/c.zip", ["id"]).collect()):
        with pytest.raises(Exception, match="no column|c.zip"):
            wrong()
