"""Intermediate tables written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and computes a table that is read twice only once; later
    jobs read files, so a lost executor costs only the tasks it was running.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
