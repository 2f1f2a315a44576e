"""Grouped statistics that stay exact and skew-safe at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup_join
from .ranking import running_total
from .scalar import round_even
from .staging import staged

QUANTILE_DIGITS = 9
# Values of a table of counts that are summed up group by group in one task
# each; more are ranged over tasks.
SMALL_VALUES = 200_000


def value_counts(df: DataFrame, group_cols: list[str], value: str, *more: Column) -> DataFrame:
    """(groups, value, n, more): rows counted by group and value, written once.

    Whatever depends on the distribution alone (quantiles, boxes, bins) is
    computed from this table, weighted by n, and the rows are not read again.
    Nulls of ``value`` are left out.  ``more`` are further aggregates.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group_cols, value)
    return staged(counts.agg(F.count(F.lit(1)).alias("n"), *more), "value-counts")


def quantiles_of(
    counts: DataFrame,
    group_cols: list[str],
    value: str,
    qs: list[float],
    names: list[str],
    digits: int | None = QUANTILE_DIGITS,
) -> DataFrame:
    """Exact linear-interpolation quantiles per group from value_counts().

    Counts are summed up in order of the values.  Of more than ``SMALL_VALUES``
    rows the values are range-partitioned in order of (group, value), so even
    one group's values are never in one task; the
    two neighbours of a quantile are the values whose span of positions holds
    them.  Results are rounded to ``digits`` decimals (engines differ in the
    last bit of the interpolation), before any comparison uses them.
    """
    groups = group_cols or ["_tl_all"]
    rows = counts if group_cols else counts.withColumn("_tl_all", F.lit(0))
    rows = rows.select(*groups, value, "n")
    if rows.count() <= SMALL_VALUES:
        own = Window.partitionBy(*groups)
        upto = F.sum("n").over(own.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        at = rows.select("*", upto.alias("_tl_upto"), F.lit(0).alias("_tl_start"), F.sum("n").over(own).alias("_tl_size"))
    else:
        upto = running_total(rows, [*groups, value], "n", "_tl_upto")
        spans = upto.groupBy(*groups).agg(F.min(F.col("_tl_upto") - F.col("n")).alias("_tl_start"), F.sum("n").alias("_tl_size"))
        at = lookup_join(upto, spans, groups, "inner")
    first, end = F.col("_tl_upto") - F.col("n") - F.col("_tl_start"), F.col("_tl_upto") - F.col("_tl_start")
    position = lambda q: F.lit(float(q)) * (F.col("_tl_size") - 1)
    holds = lambda k: F.max(F.when((first <= k) & (k < end), F.col(value).cast("double")))
    found = at.groupBy(*groups, "_tl_size").agg(
        *[holds(F.floor(position(q))).alias(f"_tl_low{i}") for i, q in enumerate(qs)],
        *[holds(F.ceil(position(q))).alias(f"_tl_high{i}") for i, q in enumerate(qs)],
    )

    def pick(i: int) -> Column:
        share = position(qs[i]) - F.floor(position(qs[i]))
        x = F.col(f"_tl_low{i}") * (F.lit(1.0) - share) + F.col(f"_tl_high{i}") * share
        return round_even(x, digits) if digits is not None else x

    return found.select(*group_cols, *[pick(i).alias(name) for i, name in enumerate(names)])


def group_quantiles(
    df: DataFrame,
    group_cols: list[str],
    value: str,
    qs: list[float],
    names: list[str],
    digits: int | None = QUANTILE_DIGITS,
) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group."""
    return quantiles_of(value_counts(df, group_cols, value), group_cols, value, qs, names, digits)


def histogram_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin index of ``x`` as numpy ``histogram`` assigns it (uniform bins).

    Edges are ``lo + i * (hi - lo) / bins`` with the last edge exactly ``hi``;
    bins are half-open except the last, which is closed.  ``lo``/``hi`` must
    already be widened by 0.5 each side when min == max (numpy does that).
    """
    step = (hi - lo) / F.lit(float(bins))
    norm = F.lit(float(bins)) / (hi - lo)
    raw = F.floor((x - lo) * norm).cast("int")
    b0 = F.when(raw >= bins, F.lit(bins - 1)).otherwise(raw)

    def edge(i: Column) -> Column:
        return F.when(i >= bins, hi).otherwise(i.cast("double") * step + lo)

    dec = F.when(x < edge(b0), b0 - 1).otherwise(b0)
    inc = F.when((x >= edge(dec + 1)) & (dec != bins - 1), dec + 1).otherwise(dec)
    return inc


def widened_range(mn: Column, mx: Column) -> tuple[Column, Column]:
    """numpy widens an empty range (min == max) by 0.5 on each side."""
    same = mn == mx
    return (
        F.when(same, mn - F.lit(0.5)).otherwise(mn),
        F.when(same, mx + F.lit(0.5)).otherwise(mx),
    )
