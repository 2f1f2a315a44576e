"""Feature engineering: skew-driven log transforms, missing checks, the
feature table, the model-ready join and the train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import adjusted_skew, hash_unit_interval_bucket, log1p_stable, round_even

# Fixed values that must equal the reference's for right results: the five
# candidate columns (in order), the skew threshold, the categorical feature,
# the target, the split seed and test share.
CANDIDATE_FEATURES = [
    "discounted_price",
    "actual_price",
    "discount_percentage",
    "rating_count",
    "review_length",
]
SKEW_THRESHOLD = 1.0
CATEGORICAL = "main_category"
TARGET = "bayesian_rating"
SPLIT_SEED = 42
TEST_FRACTION = 0.2
SKEW_DIGITS = 6
LOG_PREFIX = "log_"


def skew_report(
    df: DataFrame, columns: list[str] = CANDIDATE_FEATURES, threshold: float = SKEW_THRESHOLD
) -> DataFrame:
    """Bias-adjusted skewness per column and whether to log it (|skew| > t).

    One aggregation computes all columns' moments; the one-row result is
    unpivoted to (column_name, n, skew, need_log).
    """
    wide = df.agg(
        *[adjusted_skew(c).alias(f"s_{c}") for c in columns],
        *[F.count(c).alias(f"n_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{c}").alias("n"),
            F.col(f"s_{c}").alias("skew_raw"),
        )
        for c in columns
    ]
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.select(
        "column_name",
        "n",
        round_even("skew_raw", SKEW_DIGITS).alias("skew"),
        F.coalesce(F.abs(F.col("skew_raw")) > F.lit(threshold), F.lit(False)).alias("need_log"),
    )


def log_decisions(
    df: DataFrame, columns: list[str] = CANDIDATE_FEATURES, threshold: float = SKEW_THRESHOLD
) -> dict[str, bool]:
    """The five skew decisions as a dict (five scalars to the driver)."""
    return {r["column_name"]: bool(r["need_log"]) for r in skew_report(df, columns, threshold).collect()}


def log_features(df: DataFrame, decisions: dict[str, bool] | None = None) -> DataFrame:
    """Add ``log_<col>`` = ln(1 + col) for every column whose skew passes."""
    if decisions is None:
        decisions = log_decisions(df)
    adds = {LOG_PREFIX + c: log1p_stable(c) for c, need in decisions.items() if need}
    return df.withColumns(adds) if adds else df


def feature_columns(decisions: dict[str, bool]) -> list[str]:
    """Numeric feature names after the skew decisions: a logged column goes by
    its log, in the order in which the columns were decided."""
    return [LOG_PREFIX * logged + column for column, logged in decisions.items()]


def missing_report(df: DataFrame, required: list[str]) -> DataFrame:
    """Null count per required column (warn, never drop)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in required]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def feature_table(df_logged: DataFrame, numeric: list[str]) -> DataFrame:
    """product_id, the numeric features of feature_columns(), main_category."""
    return df_logged.select("product_id", *numeric, CATEGORICAL)


def model_ready(features: DataFrame, target: DataFrame) -> DataFrame:
    """Inner join of features with the target on product_id; rows missing a
    feature or the target are dropped."""
    merged = features.join(target.select("product_id", TARGET), "product_id", "inner")
    return merged.dropna(subset=[c for c in merged.columns if c != "product_id"])


def join_audit(features: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts before/after the merge, rows lost and null targets.

    One job: the three inputs are tagged and unioned, then counted in one
    aggregate (no cross join of one-row results).
    """
    t = target.select("product_id", TARGET)
    merged = features.select("product_id").join(t, "product_id", "inner")
    tagged = (
        features.select(F.lit("f").alias("_tl_src"), F.lit(None).cast("double").alias("_tl_y"))
        .unionByName(target.select(F.lit("t").alias("_tl_src"), F.col(TARGET).alias("_tl_y")))
        .unionByName(merged.select(F.lit("m").alias("_tl_src"), F.col(TARGET).alias("_tl_y")))
    )
    src = F.col("_tl_src")
    return tagged.agg(
        F.count_if(src == "f").alias("feature_rows"),
        F.count_if(src == "t").alias("target_rows"),
        F.count_if(src == "m").alias("merged_rows"),
        (F.count_if(src == "f") - F.count_if(src == "m")).alias("rows_lost"),
        F.count_if((src == "m") & F.col("_tl_y").isNull()).alias("null_targets"),
    )


def split_assign(
    df: DataFrame, key: str = "product_id", seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION
) -> DataFrame:
    """Deterministic 80/20 split by a per-row hash of (seed, key).

    No shuffle, no sampling job, stable under any repartitioning; the test
    share is approximately ``test_fraction``.
    """
    cut = int(test_fraction * (1 << 32))
    bucket = hash_unit_interval_bucket(key, seed)
    return df.withColumn("split", F.when(bucket < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def to_long(wide: DataFrame, id_cols: list[str], value_cols: list[str]) -> DataFrame:
    """(ids..., feature, value) rows from a wide feature table."""
    cast = wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return cast.unpivot(id_cols, value_cols, "feature", "value")
