"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import staged  # noqa: F401  (what every operator writes its intermediate tables with)

# A side is broadcast only when it was counted first and has at most this
# many rows; beyond it the caller takes a shuffle join.
BROADCAST_ROWS = 1_000_000


def small_enough(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (reads at most one more)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows one, else as it is."""
    return F.broadcast(df) if small_enough(df, max_rows) else df


TEXT_ROWS = 1000
TEXT_BYTES = 8 << 20
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bytes(setting: str) -> int:
    """Bytes of a Spark size such as ``64m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def wide_rows(df: DataFrame) -> DataFrame:
    """``df`` as it is, after limiting the session's Arrow batches to 1,000 rows
    and 8 MB.

    The defaults of 10,000 and 64 MB are meant for narrow rows; whole texts
    make batches of tens of megabytes, which stand in the executor's and the
    worker's memory several times.  A lower setting is kept.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_ROWS)) > TEXT_ROWS:
        conf.set(_BATCH_ROWS, TEXT_ROWS)
    if not 0 < _bytes(conf.get(_BATCH_BYTES)) <= TEXT_BYTES:
        conf.set(_BATCH_BYTES, TEXT_BYTES)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds at most ``max_bytes`` in each.

    A longer single row comes alone, whole.  Keeps the working set of the
    vectorised scans small whatever the batch size.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        a = 0
        while a < n:
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(a, b - a)
            a = b
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers stay around idle for
    the next task, next to the executor's heap."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)
