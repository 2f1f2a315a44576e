"""Readers and writers: listing CSVs, metric JSON, parquet gold tables.

All paths may be any Hadoop-compatible URI (HDFS, S3, ABFS, local).
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)


def strip_columns(df: DataFrame) -> DataFrame:
    """Trim whitespace around header names (the UTF-8 BOM is already dropped
    by the CSV reader)."""
    return df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])


def read_listings(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    ordinal_col: str = "ordinal",
) -> DataFrame:
    """Read listing CSV(s) with a header, every column as text.

    Quoted fields may hold commas, quotes and newlines (``multiLine``); such
    files cannot be split, so convert them to parquet once and read that.
    All files must have the header of the first one; reading raises if a file
    has other columns or the same in another order.  When the files carry no
    ``ordinal`` column, rows are numbered from 0 by file path and position.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    header = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = reader.option("enforceSchema", False).schema(schema).csv(path)
    names = strip_columns(df).columns
    if ordinal_col in names:
        return df.toDF(*names).withColumn(ordinal_col, F.col(ordinal_col).cast("long"))
    # rows of one split are numbered in a row; splits follow by path and place
    placed = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(header, names)],
        F.col("_metadata.file_path").alias("_tl_path"),
        F.col("_metadata.file_block_start").alias("_tl_start"),
        F.monotonically_increasing_id().alias("_tl_id"),
    )
    splits = placed.groupBy("_tl_path", "_tl_start").agg(F.min("_tl_id").alias("_tl_first"), F.count(F.lit(1)).alias("_tl_n"))
    # one row per file split: a window over the list of splits
    before = Window.orderBy("_tl_path", "_tl_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_tl_before", F.coalesce(F.sum("_tl_n").over(before), F.lit(0))).drop("_tl_n")
    numbered = placed.join(F.broadcast(splits), ["_tl_path", "_tl_start"])
    return numbered.select(*names, (F.col("_tl_before") + F.col("_tl_id") - F.col("_tl_first")).alias(ordinal_col))


def _write_bytes(df: DataFrame, path: str) -> str:
    """Write each row's ``content`` as a file of its own.  The text sink writes
    a string's bytes as they are, and a line feed after them."""
    raw = df.select(F.col("content").cast("string").alias("value"))
    raw.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def zip_listings(df: DataFrame, path: str, member: str = "listings.csv") -> str:
    """Write listings as zip archives, each with one CSV member with a header."""

    def pack(frames):
        for pdf in frames:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(member, pdf.to_csv(index=False))
            yield pd.DataFrame({"content": [out.getvalue()]})

    return _write_bytes(df.mapInPandas(pack, "content binary"), path)


def unzip_listings(spark: SparkSession, archives: str, out_path: str, member: str = "listings.csv") -> str:
    """Extract one member of every zip archive under a path, each to a CSV file.

    Archives are read and members written through Spark, so both paths may be
    any Hadoop URI; a task holds one archive at a time.  Read the result with
    read_listings().  An archive without the member raises.
    """

    def extract(frames):
        for pdf in frames:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    yield pd.DataFrame({"content": [archive.read(member)]})

    files = spark.read.format("binaryFile").load(archives).where("length > 0").select("content")
    return _write_bytes(files.mapInPandas(extract, "content binary"), out_path)


#: Text of one CSV file that one task writes, and reads again.
FILE_BYTES = 64 << 20


def in_files(df: DataFrame, key: str, least: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``df`` in order of ``key`` in ranges of some ``file_bytes`` of text each
    (``least`` at least), one per file when it is written.  ``df`` is read twice
    and more: pass a written table."""
    size = F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0)).cast("long"))
    n = max(least, -(-(df.agg(size).first()[0] or 0) // file_bytes))
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def write_csv(df: DataFrame, path: str, single_file: bool = False, bom: bool = False) -> str:
    """Exchange CSV with a header; quotes every field that needs it.  With
    ``bom`` every file starts with the UTF-8 byte order mark (as part of its
    first header name, which read_listings() strips again)."""
    out = df.coalesce(1) if single_file else df
    if bom:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.mode("overwrite").options(header=True, escape='"', **keep).csv(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet, optionally partitioned (only for low-cardinality columns)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> str:
    """Write metric rows, one per model, as one JSON array document."""
    doc = metrics.agg(F.to_json(F.collect_list(F.struct(*metrics.columns))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_metrics(spark: SparkSession, path: str, schema: T.StructType = METRICS_SCHEMA) -> DataFrame:
    """Read a JSON array of metric records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def materialize(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write gold tables under ``root``; later sessions read the parquet
    instead of recomputing (within a session use ``persist``)."""
    out = {}
    for name, df in tables.items():
        out[name] = write_table(df, f"{root.rstrip('/')}/{name}")
    return out
