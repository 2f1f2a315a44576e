"""Global row numbering without a single-partition window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
Instead we range-partition on the full (unique) sort key, sort inside each
partition, freeze the layout with a reliable checkpoint, and add the prefix
sum of the per-partition row counts.  Range bounds come from a sample of the
composite key, so a value shared by a third of all rows is still split over
many partitions (the tie-breaker makes every key unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir
from .staging import staged

# Rows of one range partition at most, on average; below that the session's
# shuffle partition count decides.
ROWS_PER_RANGE = 500_000

_PART_BITS = 33  # monotonically_increasing_id puts the partition id above bit 33


def global_row_number(
    df: DataFrame,
    order: list[Column],
    rank_col: str,
    num_partitions: int | None = None,
    total_col: str | None = None,
) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order``.

    ``order`` must be a total order (end it with a unique column) for the
    result to be deterministic, like pandas ``rank(method="first")`` over an
    explicit row ordinal.  ``total_col`` adds the total row count (taken from
    the same per-partition counts, no extra job).

    Pass narrow rows: all of them go through a range shuffle and a checkpoint.
    The number of ranges grows with the number of rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # written once: counted, sampled for the ranges and ranged from the files
    df = staged(df, "to-rank")
    if num_partitions is None:
        by_rows = -(-df.count() // ROWS_PER_RANGE)
        num_partitions = max(by_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    # Reliable checkpoint: partition contents and in-partition order are fixed
    # on shared storage, so both uses below see the same layout even if an
    # executor is lost or AQE would re-plan the range exchange.
    frozen = ordered.checkpoint(eager=True)
    with_id = frozen.withColumn("_tl_mid", F.monotonically_increasing_id())
    part = F.shiftright(F.col("_tl_mid"), _PART_BITS)
    local = F.col("_tl_mid").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    counts = with_id.groupBy(part.alias("_tl_part")).agg(F.count(F.lit(1)).alias("_tl_n"))
    # One row per partition: a proven bound, so this window and the broadcast
    # below are tiny whatever the data size.
    offsets = counts.withColumn(
        "_tl_off",
        F.coalesce(
            F.sum("_tl_n").over(
                Window.orderBy("_tl_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    if total_col:
        offsets = offsets.withColumn(total_col, F.sum("_tl_n").over(Window.partitionBy()))
    offsets = offsets.drop("_tl_n")
    joined = with_id.withColumn("_tl_part", part).join(F.broadcast(offsets), "_tl_part")
    return joined.withColumn(rank_col, (F.col("_tl_off") + local + F.lit(1)).cast("long")).drop(
        "_tl_mid", "_tl_part", "_tl_off"
    )


# Rows of a table that is ranked where it stands, without ranges.
SMALL_ROWS = 10_000


def row_numbers(df: DataFrame, orders: dict[str, list[Column]], small_rows: int = SMALL_ROWS) -> DataFrame:
    """Add the 1-based position in each of several total orders.

    For aggregates, of a row per category or so: they are computed once, and up
    to ``small_rows`` rows are numbered in one task.  A larger table goes
    through global_row_number(), order by order.
    """
    rows = df.limit(small_rows + 1).collect()
    if len(rows) > small_rows:
        for name, order in orders.items():
            df = global_row_number(df, order, name)
        return df
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return local.withColumns({name: F.row_number().over(Window.orderBy(*order)).cast("long") for name, order in orders.items()})


def running_total(df: DataFrame, order: list[str], weight: str, total_col: str) -> DataFrame:
    """Add ``total_col`` = sum of ``weight`` over all rows up to and including
    this one in ``order`` (which must be a total order of the rows).

    Like the row number above: ranges of the order, totals within each range,
    and the prefix sums of one total per range.
    """
    df = staged(df, "to-sum")
    by_rows = -(-df.count() // ROWS_PER_RANGE)
    ranges = max(by_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartitionByRange(ranges, *order).withColumn("_tl_part", F.spark_partition_id())
    frozen = staged(placed, "ranges")
    within = Window.partitionBy("_tl_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_tl_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = frozen.groupBy("_tl_part").agg(F.sum(weight).alias("_tl_sum"))
    # one row per range: a proven bound, as above
    offsets = parts.select("_tl_part", F.coalesce(F.sum("_tl_sum").over(before), F.lit(0)).alias("_tl_off"))
    local = frozen.withColumn(total_col, F.sum(weight).over(within))
    joined = local.join(F.broadcast(offsets), "_tl_part")
    return joined.withColumn(total_col, F.col(total_col) + F.col("_tl_off")).drop("_tl_part", "_tl_off")
