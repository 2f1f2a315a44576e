"""Review-count-aware ("Bayesian") rating per product.

m = first quartile of review counts in the product's category, C = mean
rating of the category.  Gated rule: a product with v >= m keeps its rating
R; otherwise it gets (vR + mC) / (v + m).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.ranking import global_row_number, row_numbers
from ..functions.scalar import exact_mean, round_even
from ..functions.stats import group_quantiles, quantiles_of, value_counts

# Fixed values that must equal the reference's for right results: the
# quantile that defines m, the rounding of m (1 dp) and of C and the adjusted
# rating (4 dp), and the two rule labels.
M_QUANTILE = 0.25
M_DIGITS = 1
C_DIGITS = 4
RATING_DIGITS = 4
RULE_RELIABLE = "reliable: keep original rating"
RULE_SUSPICIOUS = "suspicious: apply Bayesian formula"


def category_quantile(clean: DataFrame, value: str, q: float, group: str = "main_category") -> DataFrame:
    """Exact linear-interpolation quantile of ``value`` per group.

    Equals pandas ``quantile`` and SQL ``quantile_cont``.
    """
    return group_quantiles(clean, [group], value, [q], ["quantile"], None)


def category_values(clean: DataFrame) -> DataFrame:
    """(main_category, rating_count, n, rating_sum): the table that parameters,
    thresholds, bins and boxes per category follow from."""
    rating_sum = F.sum(F.col("rating").cast("decimal(38,4)")).alias("rating_sum")
    return value_counts(clean, ["main_category"], "rating_count", rating_sum)


def category_params(
    clean: DataFrame, m_quantile: float = M_QUANTILE, values: DataFrame | None = None
) -> DataFrame:
    """Per category: ``m_value`` (Q1 of review count, 1 dp) and
    ``category_mean_rating`` (mean rating, 4 dp), plus the unrounded mean
    ``category_mean_exact`` used by the purchase guide.

    All from category_values(), one pass over the products.
    """
    if values is None:
        values = category_values(clean)
    m = quantiles_of(values, ["main_category"], "rating_count", [m_quantile], ["_tl_q"], None)
    agg = values.groupBy("main_category").agg(
        (F.sum("rating_sum").cast("double") / F.sum("n").cast("double")).alias("category_mean_exact"),
        F.sum("n").alias("product_count"),
    )
    return lookup_join(agg, m, "main_category").select(
        "main_category",
        round_even("_tl_q", M_DIGITS).alias("m_value"),
        round_even("category_mean_exact", C_DIGITS).alias("category_mean_rating"),
        "category_mean_exact",
        "product_count",
    )


def m_values(clean: DataFrame) -> DataFrame:
    """m per category with the product count, and the place of the category in
    both display orders: most products first, and least m first (ties: name)."""
    p = category_params(clean).select("main_category", "m_value", "product_count")
    name = F.col("main_category")
    return row_numbers(p, {"count_position": [F.desc("product_count"), name], "m_position": [F.col("m_value"), name]})


def m_values_approx(clean: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Approximate Q1 per category (``percentile_approx``) for very large
    categories: bounded memory per group, no interpolation."""
    return clean.groupBy("main_category").agg(
        F.percentile_approx("rating_count", M_QUANTILE, accuracy).alias("m_value_approx"),
        F.count(F.lit(1)).alias("product_count"),
    )


def m_extremes(clean: DataFrame) -> DataFrame:
    """Categories with the highest and the lowest m (ties: category name)."""
    p = m_values(clean)
    # one row per category: two top-1 picks over a tiny table
    top = p.orderBy(F.desc("m_value"), F.asc("main_category")).limit(1).withColumn("which", F.lit("highest"))
    low = p.orderBy(F.asc("m_value"), F.asc("main_category")).limit(1).withColumn("which", F.lit("lowest"))
    return top.unionByName(low).select("which", "main_category", "m_value")


def join_params(clean: DataFrame, params: DataFrame) -> DataFrame:
    return lookup_join(clean, params.select("main_category", "m_value", "category_mean_rating"), "main_category")


def gated_rating(v: str = "rating_count", r: str = "rating", m: str = "m_value", c: str = "category_mean_rating"):
    """v >= m -> R, else (vR + mC)/(v + m); rounded to 4 dp (half to even)."""
    V, R, M, C = F.col(v), F.col(r), F.col(m), F.col(c)
    raw = F.when(V >= M, R).otherwise((V * R + M * C) / (V + M))
    return round_even(raw, RATING_DIGITS)


def trust_rating(clean: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """``products_trust``: the clean table plus ``bayesian_rating``."""
    base = clean.dropna(subset=["main_category", "rating", "rating_count"])
    if params is None:
        params = category_params(base)
    joined = join_params(base, params)
    return joined.withColumn("bayesian_rating", gated_rating()).drop("m_value", "category_mean_rating")


def trust_detail(clean: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Per product: parameters, suspicion flag, adjusted rating, gap, rule."""
    base = clean.dropna(subset=["main_category", "rating", "rating_count"])
    if params is None:
        params = category_params(base)
    joined = join_params(base, params)
    suspicious = F.col("rating_count") < F.col("m_value")
    return joined.select(
        "product_id",
        "product_name",
        "main_category",
        "rating",
        "rating_count",
        "m_value",
        "category_mean_rating",
        F.coalesce(suspicious, F.lit(False)).alias("is_suspicious"),
        gated_rating().alias("bayesian_rating"),
        "ordinal",
    ).withColumns(
        {
            "rating_gap": round_even(F.col("rating") - F.col("bayesian_rating"), RATING_DIGITS),
            "target_rule": F.when(F.col("is_suspicious"), F.lit(RULE_SUSPICIOUS)).otherwise(
                F.lit(RULE_RELIABLE)
            ),
        }
    )


# Fixed: the columns of the rank-movers table, in this order.
RANK_COLUMNS = [
    "product_id",
    "product_name",
    "main_category",
    "rating",
    "rating_count",
    "m_value",
    "category_mean_rating",
    "is_suspicious",
    "bayesian_rating",
    "rating_gap",
    "rating_rank",
    "bayesian_rank",
    "rank_change",
    "target_rule",
]


def product_ranks(detail: DataFrame) -> DataFrame:
    """(ordinal, product_id, rating_rank, bayesian_rank, rank_change,
    abs_rank_change): ranks by rating and by adjusted rating (descending, ties
    by row order); positive change = the product fell.

    Only these few columns are ranged and checkpointed, never the labels.
    """
    narrow = detail.select("ordinal", "product_id", "rating", "bayesian_rating")
    r1 = global_row_number(narrow, [F.desc("rating"), F.asc("ordinal")], "rating_rank")
    r2 = global_row_number(r1, [F.desc("bayesian_rating"), F.asc("ordinal")], "bayesian_rank")
    change = F.col("bayesian_rank") - F.col("rating_rank")
    ranks = r2.withColumn("rank_change", change).withColumn("abs_rank_change", F.abs(change))
    return ranks.drop("rating", "bayesian_rating")


def rank_movers(detail: DataFrame) -> DataFrame:
    """``detail`` with the columns of product_ranks()."""
    return detail.join(product_ranks(detail).drop("product_id"), "ordinal")


def rank_movers_top(detail: DataFrame, k: int = 50) -> DataFrame:
    """The k products whose rank moves most (ties: product id).

    A top-k of narrow rows; the k winners' other columns are fetched after.
    """
    top = product_ranks(detail).orderBy(F.desc("abs_rank_change"), F.asc("product_id")).limit(k)
    return lookup_join(detail, top.drop("product_id"), "ordinal", "inner").select(*RANK_COLUMNS)


def trust_summary(detail: DataFrame) -> DataFrame:
    """Run totals: products, reliable, suspicious, share, mean ratings, gap."""
    total = F.count(F.lit(1))
    susp = F.count_if(F.col("is_suspicious"))
    return detail.agg(
        total.alias("total_products"),
        (total - susp).alias("reliable_products"),
        susp.alias("suspicious_products"),
        round_even(F.try_divide(susp.cast("double"), total.cast("double")) * F.lit(100.0), 2).alias("suspicious_pct"),
        round_even(exact_mean("rating", 4), 4).alias("mean_rating"),
        round_even(exact_mean("bayesian_rating", 4), 4).alias("mean_bayesian_rating"),
        round_even(exact_mean("rating_gap", 4), 4).alias("mean_rating_gap"),
    )


def m_choice_compare(clean: DataFrame) -> DataFrame:
    """Per category: suspects under m = median against m = Q1 (1 dp), counted
    from category_values() alone."""
    values = category_values(clean)
    params = category_params(clean, values=values).select("main_category", "m_value")
    med = quantiles_of(values, ["main_category"], "rating_count", [0.5], ["median_m"])
    joined = lookup_join(values, params.join(med, "main_category"), "main_category")
    n = F.sum("n")
    below = lambda m: F.sum(F.when(F.col("rating_count") < F.col(m), F.col("n")).otherwise(0))
    pct = lambda m: round_even(below(m).cast("double") / n.cast("double") * F.lit(100.0), 1)
    return joined.groupBy("main_category").agg(
        n.alias("product_count"),
        F.max("median_m").alias("median_m"),
        F.max("m_value").alias("q1_m"),
        below("median_m").alias("suspect_median"),
        pct("median_m").alias("pct_median"),
        below("m_value").alias("suspect_q1"),
        pct("m_value").alias("pct_q1"),
    )
