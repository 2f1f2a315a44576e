"""Multi-line CSV files read by many tasks each.

A quoted field may hold line ends, so where a record begins cannot be told from
a place in the file alone; Spark's own reader gives such a file to one task.
Here a file is read as lines, in the byte ranges that Spark cuts text files
into, twice:

1. Index.  A line begins inside a quoted field or outside; for each of the two,
   it can be told where its end is.  So can it for a whole range: every task
   gives, for both possible beginnings, how its range ends and how many records
   begin in it.  Ranges in order then say how each one really begins - by the
   last range before it that ends alike either way, and the parity of those
   that turn the state around - and, by prefix sums, the number of its first
   record.
2. Records.  Every task puts the lines of its range together to records and
   numbers them.  Only the pieces of records that cross a border of ranges are
   grouped by number; all other text stays where it was read.

The records are parsed by ``from_csv``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.staging import staged

QUOTE, COMMA = '"', ","
# from inside a quoted field to its closing quote, doubled ones passed over
_CLOSE = re.compile(r'(?:[^"]|"")*+"')
BATCH_ROWS = 1000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field, or at the first field
    of a record, ends inside one.  A quote opens a field only where it begins."""
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if inside:
            close = _CLOSE.match(line, at)
            if not close:
                return True
            inside, at = False, close.end()
        elif line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(COMMA, at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as they are (carriage returns kept), in order within a range."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(path, start, lines) of runs of lines of one range, in order."""
    for b in batches:
        n, a = b.num_rows, 0
        paths, starts = b.column("path").to_pylist(), b.column("start").to_pylist()
        values = b.column("value").to_pylist()
        while a < n:
            e = a + 1
            while e < n and starts[e] == starts[a] and paths[e] == paths[a]:
                e += 1
            yield paths[a], starts[a], values[a:e]
            a = e


_INDEX = "path string, start long, end_out boolean, end_in boolean, n_out long, n_in long"


def _index_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: its end and its records for either beginning."""
    key, state, begun = None, [False, True], [0, 0]

    def row():
        cols = [[key[0]], [key[1]], [state[0]], [state[1]], [begun[0]], [begun[1]]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["path", "start", "end_out", "end_in", "n_out", "n_in"])

    for path, start, lines in _runs(batches):
        if (path, start) != key:
            if key is not None:
                yield row()
            key, state, begun = (path, start), [False, True], [0, 0]
        for line in lines:
            filled = line not in ("", "\r")
            for i in (0, 1):
                begun[i] += filled and not state[i]
            if QUOTE in line:
                # once both agree they go on alike
                first = ends_inside(line, state[0])
                state = [first, first if state[0] == state[1] else ends_inside(line, state[1])]
    if key is not None:
        yield row()


def range_index(lines: DataFrame) -> DataFrame:
    """(path, start, inside, first): whether each range begins inside a quoted
    field, and the number of the first record that begins in it.

    Windows over the list of ranges, of which there is one per 128 MB of text
    or so; the numbers run over the files by path.
    """
    found = staged(lines.mapInArrow(_index_ranges, _INDEX), "csv-ranges")
    same, turned = F.col("end_out") == F.col("end_in"), F.col("end_out") & ~F.col("end_in")
    within = Window.partitionBy("path").orderBy("start")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    # turns up to and with each range; a range that ends alike either way fixes the state
    counted = found.withColumn("turns", F.sum(turned.cast("long")).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(same, F.struct((F.col("end_out").cast("long") + F.col("turns")).alias("base")))
    known = counted.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    turns_before = F.col("turns") - turned.cast("long")
    inside = (F.coalesce(F.col("fixed.base"), F.lit(0)) + turns_before) % 2 == 1
    placed = known.withColumn("inside", inside).withColumn("n", F.when(inside, F.col("n_in")).otherwise(F.col("n_out")))
    # files one after another: a sum per file, then one over the list of files
    files = placed.groupBy("path").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_first"))
    placed = placed.withColumn("in_file", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return placed.join(files, "path").select("path", "start", "inside", (F.col("file_first") + F.col("in_file")).alias("first"), "file_first")


_PIECES = "path string, record long, header boolean, start long, whole boolean, text string"


def _pieces(index):
    """Tasks: lines to records, and to the pieces of those that cross a border."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key = None
        open_lines: list[str] | None = None  # of the record being put together
        inside, number, file_first, crossed = False, 0, 0, False

        def close(whole: bool):
            # a record that another range began, or will end, is not whole
            out.append((key[0], number - 1, number - 1 == file_first, key[1], whole and not crossed, "\n".join(open_lines)))

        def batch():
            cols = list(zip(*out))
            out.clear()
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.string()]
            names = ["path", "record", "header", "start", "whole", "text"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for path, start, lines in _runs(batches):
            if (path, start) != key:
                if open_lines is not None:
                    close(False)
                key = (path, start)
                inside, number, file_first = index.value[key]
                crossed = inside
                open_lines = [] if inside else None
            for line in lines:
                if open_lines is None:
                    if line in ("", "\r"):
                        continue  # no record begins with an empty line
                    open_lines, number = [], number + 1
                open_lines.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    close(True)
                    open_lines, crossed = None, False
            if len(out) >= BATCH_ROWS:
                yield batch()
        if open_lines is not None:
            close(False)
        if out:
            yield batch()

    return run


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, record, header, text): every record of the CSV files under
    ``path``, numbered from 0 by path and place, each file's first marked.

    Lines end with LF or CRLF; empty lines between records are no records.  A
    quoted field may hold anything, with quotes doubled.
    """
    lines = _lines(spark, path)
    # one row per range of some 128 MB; what a task needs to begin with
    rows = range_index(lines).collect()
    index = spark.sparkContext.broadcast({(r.path, r.start): (r.inside, r.first, r.file_first) for r in rows})
    pieces = staged(lines.mapInArrow(_pieces(index), _PIECES), "csv-records")
    whole = pieces.where("whole").select("path", "record", "header", "text")
    # at most two pieces per border of ranges
    parts = pieces.where(~F.col("whole")).groupBy("path", "record", "header").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"))
    joined = parts.select("path", "record", "header", F.array_join(F.col("parts.text"), "\n").alias("text"))
    return whole.unionByName(joined).withColumn("text", F.regexp_replace("text", r"\r$", ""))


def read_split_csv(spark: SparkSession, path: str | list[str], ordinal_col: str = "ordinal") -> DataFrame:
    """What ``io.read_listings`` reads, with as many tasks per file as it has
    ranges (``spark.sql.files.maxPartitionBytes`` is their size).

    Every column is text.  All files must have the header of the first one;
    a byte order mark and white space around its names are dropped.  When the
    files have no ``ordinal`` column, rows are numbered from 0 by file path and
    place.
    """
    records = csv_records(spark, path)
    headers = [r.text for r in records.where("header").select("text").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError("no header" if not headers else f"files with different headers: {headers}")
    options = {"escape": QUOTE, "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    names = [n.strip().lstrip("\ufeff").strip() for n in _header_names(spark, headers[0], options)]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.where(~F.col("header")).withColumn("row", F.from_csv("text", schema, options))
    cols = [F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)]
    if ordinal_col in names:
        return rows.select(*cols).withColumn(ordinal_col, F.col(ordinal_col).cast("long"))
    # headers before a record are not rows: one per file up to its own
    paths = records.where("header").select("path", F.row_number().over(Window.orderBy("path")).alias("headers"))
    numbered = rows.join(F.broadcast(paths), "path")
    return numbered.select(*cols, (F.col("record") - F.col("headers")).alias(ordinal_col))


def _header_names(spark: SparkSession, header: str, options: dict[str, str]) -> list[str]:
    one = spark.createDataFrame([(header,)], "text string")
    width = header.count(COMMA) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = one.select(F.from_csv("text", schema, options).alias("r")).first().r
    found = [row[f"c{i}"] for i in range(width)]
    while len(found) > 1 and found[-1] is None:
        found.pop()
    return [n or "" for n in found]
