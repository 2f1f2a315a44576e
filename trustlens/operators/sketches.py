"""Stored sketches per category: quantiles of review counts, distinct products.

A batch of products becomes one row per category - its size, a KLL sketch of
review counts and a HyperLogLog sketch of product ids - of a few kilobytes
whatever the batch.  Rows of any batches and any categories can be merged, so
quantiles and distinct counts of the whole catalogue, of one category or of any
set of them follow without reading a product again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K = 400
HLL_LOG2 = 12


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of a sketched quantile may be off, as a share of the
    rows, with 99 % confidence; merging does not add to it."""
    return 2.296 / k**0.9723


def distinct_error(log2: int = HLL_LOG2) -> float:
    """Relative error of a distinct count, three standard deviations."""
    return 3 * 1.04 / 2 ** (log2 / 2)


def category_sketches(clean: DataFrame, k: int = KLL_K, log2: int = HLL_LOG2) -> DataFrame:
    """(main_category, n, reviews, products) of a batch of products.

    ``n`` counts the products with a review count, which are sketched in
    ``reviews``; ``products`` sketches all product ids.  Nulls are left out.
    """
    return clean.groupBy("main_category").agg(
        F.count("rating_count").alias("n"),
        F.kll_sketch_agg_bigint(F.col("rating_count").cast("long"), F.lit(k)).alias("reviews"),
        F.hll_sketch_agg("product_id", F.lit(log2)).alias("products"),
    )


def merge_sketches(*batches: DataFrame) -> DataFrame:
    """One row per category of all batches."""
    rows = reduce(DataFrame.unionByName, batches)
    return rows.groupBy("main_category").agg(
        F.sum("n").alias("n"),
        F.kll_merge_agg_bigint("reviews").alias("reviews"),
        F.hll_union_agg("products").alias("products"),
    )


def sketch_quantiles(sketches: DataFrame, qs: list[float], names: list[str]) -> DataFrame:
    """Per category the review counts at the given ranks; null without any."""
    at = lambda q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("reviews", F.lit(float(q))))
    return sketches.select("main_category", "n", *(at(q).alias(name) for q, name in zip(qs, names)))


def distinct_products(sketches: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """One row: distinct products of the given categories, by default of all;
    a product that stands in several counts once."""
    some = sketches if categories is None else sketches.where(F.col("main_category").isin(categories))
    union = some.agg(F.hll_union_agg("products").alias("u"))
    return union.select(F.coalesce(F.hll_sketch_estimate("u"), F.lit(0)).alias("products"))


def distinct_per_category(sketches: DataFrame) -> DataFrame:
    """(main_category, products): distinct products of each category."""
    return sketches.select("main_category", F.hll_sketch_estimate("products").alias("products"))
