"""Multi-line CSV files cut into ranges, against one parser for all of it."""

import csv
import io
import random

import pytest

from trustlens.sources import io as IO
from trustlens.sources import split_csv as SC


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng):
    kind = rng.random()
    text = "".join(rng.choice("ab c,\"\n\r'é—") for _ in range(rng.randint(0, 12)))
    if kind < 0.05:
        text = "line\n" * rng.randint(100, 400)  # longer than many ranges
    if kind < 0.15:
        return "5\" screen"  # a quote inside a field that is not quoted
    if kind < 0.6 or any(x in text for x in ",\"\n\r") or not text:
        return '"' + text.replace('"', '""') + '"'
    return text


def parsed(text):
    """Records of a file by the standard library, empty lines left out."""
    return [r for r in csv.reader(io.StringIO(text, newline=""), strict=False) if r]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_a_single_parser(spark, tmp_path, small_ranges, end):
    rng = random.Random(end)
    files, want, number = {}, [], 0
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = [",".join(field(rng) for _ in range(3)) for _ in range(rng.randint(40, 90))]
        body = "id,x,y" + end + "".join(r + end * rng.choice([1, 1, 1, 2]) for r in rows)
        if name == "b.csv":
            body = body.rstrip("\r\n")  # no line end at the end of the file
        files[name] = body
        (tmp_path / name).write_bytes(body.encode())
        for r in parsed(body)[1:]:
            want.append((*r, number))
            number += 1
    read = SC.read_split_csv(spark, str(tmp_path))
    got = sorted(((*[v or "" for v in r[:3]], r[3]) for r in read.collect()), key=lambda r: r[3])
    assert got == want
    lines = SC._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10
    index = SC.range_index(lines).collect()
    assert sum(r.inside for r in index) > 3  # ranges do begin inside fields


def test_same_as_the_whole_file_reader(spark, tmp_path, small_ranges):
    rows = [(i, f"name {i}", 'He said "no",\nthen\n\nleft' if i % 3 else None, "é" * (i % 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, product_name string, review_content string, z string")
    path = IO.write_csv(df.coalesce(1), str(tmp_path / "out"), single_file=True, bom=True)
    whole = IO.read_listings(spark, path)
    split = SC.read_split_csv(spark, path)
    assert split.columns == whole.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿ id , x \n1,2\n")
    assert SC.read_split_csv(spark, str(tmp_path)).columns == ["id", "x", "ordinal"]
    (tmp_path / "b.csv").write_text("x,id\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        SC.read_split_csv(spark, str(tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        SC.read_split_csv(spark, str(tmp_path / "none"))


def test_an_own_ordinal_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ordinal,x\n7,"a\nb"\n9,c\n')
    assert [tuple(r) for r in SC.read_split_csv(spark, str(tmp_path)).orderBy("ordinal").collect()] == [(7, "a\nb"), (9, "c")]


@pytest.mark.parametrize("line,outside,inside", [("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('"a""', True, False), ('""', False, True), ('x,"', True, False), ('a","b', True, True), ('a""b"', False, False)])
def test_ends_inside(line, outside, inside):
    assert (SC.ends_inside(line, False), SC.ends_inside(line, True)) == (outside, inside)
