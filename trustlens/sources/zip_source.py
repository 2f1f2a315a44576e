"""Zip archives of listing CSVs as a data source.

``spark.read.format("ziplistings")`` reads members of zip archives as rows.
The archives' directories are read on planning: every member is a partition of
its own, so one archive with many members is read by many tasks, and a task
reads its member's bytes alone.  Members are streamed: what a task holds is one
batch of rows, no archive, no member and no CSV file in between.

Options: ``path`` (archives, folders of them, or a glob; any URI that Arrow's
file systems open), ``members`` (a glob over member names, ``*.csv`` by
default).  The schema given to the reader says which columns are read, by their
names in the members' headers, all as text; ``_archive``, ``_member`` and
``_row`` (its place in the member, from 0) may be among them.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH_ROWS = 1000
PLACES = {"_archive": pa.string(), "_member": pa.string(), "_row": pa.int64()}
FIELD_BYTES = 1 << 27  # of one field; the csv module's own limit is 128 kB


@dataclass
class Member(InputPartition):
    archive: str
    name: str


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):  # Hadoop writes file:/a, Arrow reads file:///a
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def archives(path: str) -> list[str]:
    """Files of a path: itself, those in the folder, or those that a glob in
    its last part names; hidden and empty files are left out."""
    prefix = path.split("://")[0] + "://" if "://" in path else ""
    head, _, pattern = path.rstrip("/").rpartition("/")
    globbed = any(c in pattern for c in "*?[")
    system, inner = _opened(head if globbed else path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner))
    names = [
        f.path
        for f in found
        if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", ".")) and (not globbed or fnmatch.fnmatch(f.base_name, pattern))
    ]
    # what Arrow returns has no scheme; other schemes than file keep theirs
    return sorted(prefix + n.lstrip("/") if prefix and not prefix.startswith("file") else n for n in names)


class ZipListings(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ziplistings"

    def schema(self) -> T.StructType:
        """Without a schema: the columns of the first member's header."""
        members = _members(self.options)
        if not members:
            raise ValueError("no member to take the columns from")
        with _rows(members[0]) as rows:
            header = next(rows.reader, [])
        return T.StructType([T.StructField(c.strip(), T.StringType()) for c in header])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipReader(schema, self.options)


def _members(options) -> list[Member]:
    pattern = options.get("members", "*.csv")
    out = []
    for uri in archives(options["path"]):
        system, path = _opened(uri)
        # the directory stands at the end of an archive; nothing else is read
        with system.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
            out += [Member(uri, i.filename) for i in archive.infolist() if not i.is_dir() and fnmatch.fnmatch(i.filename, pattern)]
    return out


class _rows:
    """A member's records, as a context: everything is closed after."""

    def __init__(self, member: Member):
        self.member = member

    def __enter__(self):
        csv.field_size_limit(FIELD_BYTES)
        system, path = _opened(self.member.archive)
        self.raw = system.open_input_file(path)
        self.archive = zipfile.ZipFile(self.raw)
        self.stream = self.archive.open(self.member.name)
        self.reader = csv.reader(io.TextIOWrapper(self.stream, "utf-8-sig", newline=""))
        return self

    def __exit__(self, *_):
        for x in (self.stream, self.archive, self.raw):
            x.close()


class ZipReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.columns, self.options = schema.names, dict(options)
        wrong = [f.name for f in schema if f.dataType != T.StringType() and f.name != "_row"]
        if wrong:
            raise ValueError(f"only text columns: {wrong}")

    def partitions(self) -> list[InputPartition]:
        return _members(self.options)

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no member at all
            return
        with _rows(partition) as rows:
            header = [c.strip() for c in next(rows.reader, [])]
            missing = [c for c in self.columns if c not in header and c not in PLACES]
            if missing:
                raise ValueError(f"{partition.archive}: {partition.name} has no column {missing}")
            at = [header.index(c) if c in header else None for c in self.columns]
            held: list[list[str]] = []
            first = 0
            for record in rows.reader:
                if not record:
                    continue  # an empty line
                held.append(record)
                if len(held) == BATCH_ROWS:
                    yield self._batch(partition, held, at, first)
                    first += len(held)
                    held = []
            if held:
                yield self._batch(partition, held, at, first)

    def _batch(self, partition: Member, records: list[list[str]], at: list[int | None], first: int) -> pa.RecordBatch:
        n, cols = len(records), []
        for column, i in zip(self.columns, at):
            if i is not None:
                # an empty field is a missing value, as for Spark's CSV reader
                cols.append(pa.array([(r[i] or None) if i < len(r) else None for r in records], pa.string()))
            elif column == "_row":
                cols.append(pa.array(range(first, first + n), pa.int64()))
            else:
                cols.append(pa.array([partition.archive if column == "_archive" else partition.name] * n, pa.string()))
        return pa.RecordBatch.from_arrays(cols, names=self.columns)


def read_zip_listings(spark: SparkSession, path: str, columns: list[str], members: str = "*.csv", ordinal_col: str = "ordinal") -> DataFrame:
    """The given columns of the listings in zip archives, all text but the
    ordinal; a column that is not asked for is not turned into rows.

    Members must have all of them, in any order.  Empty archives and members
    give no rows.
    """
    spark.dataSource.register(ZipListings)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.format("ziplistings").schema(schema).option("path", path).option("members", members).load()
    return rows.withColumn(ordinal_col, F.col(ordinal_col).cast("long")) if ordinal_col in columns else rows
