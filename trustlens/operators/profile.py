"""Distribution profiles of ratings and review counts (the EDA charts,
re-aimed as tables: one groupBy over all categories instead of a loop of
filters per category)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.ranking import global_row_number, row_numbers
from ..functions.scalar import exact_mean, log10p, quintile_of_rank, round_even
from ..functions.stats import group_quantiles, histogram_bin, quantiles_of, value_counts, widened_range
from .trust import category_params, category_values

# Fixed values that must equal the reference's for right results: the five
# review-count group labels (in order), the histogram bin count, the whisker
# factor, the preview size and seed, and the extreme-group quantiles.
QUINTILE_LABELS = ["0-20%", "20-40%", "40-60%", "60-80%", "80-100%"]
HIST_BINS = 15
WHISKER = 1.5
PREVIEW_ROWS = 8
PREVIEW_SEED = 42
LOW_Q, HIGH_Q = 0.2, 0.8
STD_DIGITS = 6
MEAN_DIGITS = 4


def category_counts(clean: DataFrame) -> DataFrame:
    """Products per category, and its place in display order (count desc, then
    name)."""
    counts = clean.groupBy("main_category").agg(F.count(F.lit(1)).alias("product_count"))
    return row_numbers(counts, {"position": [F.desc("product_count"), F.col("main_category")]})


def kpis(clean: DataFrame) -> DataFrame:
    """Distinct products and categories, mean rating and mean review count."""
    return clean.agg(
        F.countDistinct("product_id").alias("distinct_products"),
        F.countDistinct("main_category").alias("distinct_categories"),
        round_even(exact_mean("rating", 4), MEAN_DIGITS).alias("mean_rating"),
        round_even(exact_mean("rating_count", 2), MEAN_DIGITS).alias("mean_review_count"),
    )


def kpis_approx(clean: DataFrame, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog distinct counts for catalogues too large for exact ones."""
    return clean.agg(
        F.approx_count_distinct("product_id", rsd).alias("distinct_products_approx"),
        F.approx_count_distinct("main_category", rsd).alias("distinct_categories_approx"),
    )


RANK_KEEP = ["product_id", "ordinal", "main_category", "rating", "rating_count"]


def review_quintile(clean: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rank by review count (ties by row order) and its quintile group.

    Only ``keep`` columns go through the range shuffle and the checkpoint
    (never the review text).
    """
    cols = keep or RANK_KEEP
    ranked = global_row_number(
        clean.select(*cols), [F.asc("rating_count"), F.asc("ordinal")], "review_rank", total_col="_tl_total"
    )
    q = quintile_of_rank(F.col("review_rank"), F.col("_tl_total"))
    labels = F.array(*[F.lit(x) for x in QUINTILE_LABELS])
    return (
        ranked.withColumn("quintile", q)
        .withColumn("review_count_group", F.element_at(labels, F.col("quintile")))
        .drop("_tl_total")
    )


def quintile_summary(clean: DataFrame) -> DataFrame:
    """Rating mean / median / sample std / min / max per review quintile."""
    rq = review_quintile(clean).select("quintile", "review_count_group", "rating")
    med = group_quantiles(rq, ["quintile"], "rating", [0.5], ["rating_median"])
    agg = rq.groupBy("quintile", "review_count_group").agg(
        F.count(F.lit(1)).alias("product_count"),
        round_even(exact_mean("rating", 4), MEAN_DIGITS).alias("rating_mean"),
        round_even(F.stddev_samp("rating"), STD_DIGITS).alias("rating_std"),
        F.min("rating").alias("rating_min"),
        F.max("rating").alias("rating_max"),
    )
    # five rows each side: the join is trivially small
    return agg.join(F.broadcast(med), "quintile")


def extreme_bounds(clean: DataFrame) -> tuple[float, float]:
    """Global 20 % and 80 % quantiles of review count (two scalars)."""
    row = group_quantiles(clean, [], "rating_count", [LOW_Q, HIGH_Q], ["q_low", "q_high"]).first()
    # without any product there is no bound, and no row to hold against it
    return (float(row["q_low"]), float(row["q_high"])) if row else (float("nan"), float("nan"))


def extremes_groups(clean: DataFrame) -> DataFrame:
    """Rows of the bottom-20 % (count <= q20) and top-20 % (count >= q80)
    groups; bounds are inclusive, so a row can be in both."""
    q_low, q_high = extreme_bounds(clean)
    x = F.col("rating_count")
    group = lambda name, bound: F.struct(F.lit(name).alias("extreme_group"), F.lit(bound).alias("threshold"))
    both = F.array(F.when(x <= q_low, group("bottom_20", q_low)), F.when(x >= q_high, group("top_20", q_high)))
    # one pass: a row is repeated for each group that it is in
    rows = clean.withColumn("_tl_group", F.explode(F.filter(both, lambda g: g.isNotNull())))
    return rows.select(*clean.columns, "_tl_group.extreme_group", "_tl_group.threshold")


def extremes_compare(clean: DataFrame) -> DataFrame:
    """Size, rating spread and mean of the two extreme groups."""
    g = extremes_groups(clean)
    return g.groupBy("extreme_group").agg(
        F.max("threshold").alias("threshold"),
        F.count(F.lit(1)).alias("product_count"),
        round_even(F.stddev_samp("rating"), STD_DIGITS).alias("rating_std"),
        round_even(exact_mean("rating", 4), MEAN_DIGITS).alias("rating_mean"),
    )


def category_profile(clean: DataFrame) -> DataFrame:
    """Per category: size, mean review count, median and Q1 m, mean rating;
    all from category_values()."""
    values = category_values(clean)
    params = category_params(clean, values=values)
    med = quantiles_of(values, ["main_category"], "rating_count", [0.5], ["median_m"])
    reviews = F.sum(F.col("rating_count").cast("decimal(18,2)") * F.col("n").cast("decimal(18,0)"))
    mean = lambda x: round_even(x.cast("double") / F.sum("n").cast("double"), MEAN_DIGITS)
    agg = values.groupBy("main_category").agg(
        F.sum("n").alias("product_count"),
        mean(reviews).alias("mean_review_count"),
        mean(F.sum("rating_sum")).alias("mean_rating"),
    )
    p = params.select("main_category", F.col("m_value").alias("q1_m")).join(med, "main_category")
    return lookup_join(agg, p, "main_category")


def with_log_count(clean: DataFrame) -> DataFrame:
    return clean.withColumn("log_review_count", log10p("rating_count"))


def histogram15(clean: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Per category, ``bins`` equal-width bins of log10(count + 1), empty bins
    included, the way the plotting library bins them."""
    counts = value_counts(with_log_count(clean), ["main_category"], "log_review_count")
    rng = counts.groupBy("main_category").agg(
        F.min("log_review_count").alias("_mn"), F.max("log_review_count").alias("_mx")
    )
    lo, hi = widened_range(F.col("_mn"), F.col("_mx"))
    rng = rng.select("main_category", lo.alias("bin_range_lo"), hi.alias("bin_range_hi"))
    binned = lookup_join(counts, rng, "main_category", "inner").withColumn(
        "bin", histogram_bin(F.col("log_review_count"), F.col("bin_range_lo"), F.col("bin_range_hi"), bins)
    )
    filled = binned.groupBy("main_category", "bin").agg(F.sum("n").alias("product_count"))
    # every (category, bin) pair, generated from the one-row-per-category range
    grid = rng.select(
        "main_category", "bin_range_lo", "bin_range_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    step = (F.col("bin_range_hi") - F.col("bin_range_lo")) / F.lit(float(bins))
    out = grid.join(filled, ["main_category", "bin"], "left")
    return out.select(
        "main_category",
        "bin",
        (F.col("bin").cast("double") * step + F.col("bin_range_lo")).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, F.col("bin_range_hi"))
        .otherwise((F.col("bin") + 1).cast("double") * step + F.col("bin_range_lo"))
        .alias("bin_hi"),
        F.coalesce(F.col("product_count"), F.lit(0)).alias("product_count"),
    )


def box_stats(df: DataFrame, group_cols: list[str], value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (furthest point inside) and outlier count,
    all from the values and how often each occurs."""
    counts = value_counts(df, group_cols, value)
    qs = quantiles_of(counts, group_cols, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    qs = qs.withColumns(
        {
            "lo_fence": F.col("q1") - F.lit(WHISKER) * iqr,
            "hi_fence": F.col("q3") + F.lit(WHISKER) * iqr,
        }
    )
    joined = lookup_join(counts, qs, group_cols, "inner")
    v = F.col(value)
    outside = (v < F.col("lo_fence")) | (v > F.col("hi_fence"))
    return joined.groupBy(*group_cols).agg(
        F.sum("n").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_high"),
        F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("n_outliers"),
    )


def box_stats_quintile(clean: DataFrame) -> DataFrame:
    """Rating boxes by review-count quintile."""
    rq = review_quintile(clean).select("quintile", "review_count_group", "rating")
    return box_stats(rq, ["quintile", "review_count_group"], "rating")


def box_stats_category(clean: DataFrame) -> DataFrame:
    """Boxes of log10(count + 1) by category."""
    return box_stats(with_log_count(clean), ["main_category"], "log_review_count")


def box_stats_extremes(clean: DataFrame) -> DataFrame:
    """Rating boxes of the bottom-20 % and top-20 % review-count groups."""
    return box_stats(extremes_groups(clean), ["extreme_group"], "rating")


def funnel_grid(clean: DataFrame, per_decade: int = 4) -> DataFrame:
    """2-D binned counts of (log10(count + 1), rating) per category.

    The scatter of every product does not scale; a grid of quarter-decade
    count bins by rating tenths does, and draws the same funnel.
    """
    x = with_log_count(clean)
    return x.groupBy(
        "main_category",
        F.floor(F.col("log_review_count") * F.lit(per_decade)).cast("int").alias("log_count_bin"),
        F.rint(F.col("rating") * F.lit(10.0)).cast("int").alias("rating_tenths"),
    ).agg(F.count(F.lit(1)).alias("product_count"))


def preview_sample(trust: DataFrame, k: int = PREVIEW_ROWS, seed: int = PREVIEW_SEED) -> DataFrame:
    """A fixed pseudo-random sample of ``k`` products: hash order, top-k."""
    h = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col("product_id")))
    return (
        trust.withColumn("_tl_h", h)
        .orderBy("_tl_h")
        .limit(k)
        .select("product_id", "product_name", "main_category", "rating", "rating_count", "bayesian_rating")
    )


__all__ = [
    "category_counts",
    "kpis",
    "kpis_approx",
    "review_quintile",
    "quintile_summary",
    "extremes_compare",
    "category_profile",
    "histogram15",
    "box_stats",
    "box_stats_quintile",
    "box_stats_category",
    "box_stats_extremes",
    "funnel_grid",
    "preview_sample",
]
