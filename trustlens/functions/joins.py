"""Joins against lookup tables (per-category parameters, domains, ranges).

A lookup table is an aggregate with one row per key, usually a few dozen rows
against billions.  A plain join of the two lets the planner shuffle the big
side by a key of which one value may hold a third of all rows, and no rule
splits that shuffle when the other side is an aggregate.  So the lookup side
is computed first and its rows are counted: a small one is broadcast, and the
big side is not moved at all; a large one is joined on (key, salt), which
spreads every hot key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

# Lookup rows that are collected and broadcast; they hold a key and a few
# numbers each, so this is a megabyte or two.
BROADCAST_ROWS = 10_000
SALTS = 32


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` with the lookup table ``small`` on equal key columns.

    ``how`` is ``left``, ``inner`` or ``left_semi``.  Null keys match nothing.
    """
    keys = [on] if isinstance(on, str) else list(on)
    rows = small.limit(broadcast_rows + 1).collect()
    if len(rows) <= broadcast_rows:
        local = small.sparkSession.createDataFrame(rows, small.schema)
        return big.join(F.broadcast(local), keys, how)
    # any salt finds its copy, so rows are dealt round without reading a column
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    copies = staged(small, "lookup").withColumn("_tl_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("_tl_salt", F.col("_tl_salt").cast("long"))
    return big.withColumn("_tl_salt", spread).join(copies, [*keys, "_tl_salt"], how).drop("_tl_salt")
