"""Regression models with Spark ML: one-hot pipeline, three regressors,
hold-out evaluation and model comparison."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.scalar import round_even
from ..functions.staging import staged
from .features import CATEGORICAL, TARGET

# Fixed values that must equal the reference's for right results: tree and
# boosting-round counts, the seed, and the 4-dp rounding of the metrics.
N_TREES = 200
N_ROUNDS = 200
MODEL_SEED = 42
METRIC_DIGITS = 4
MODEL_NAMES = ["Linear Regression", "Random Forest", "Gradient Boosting"]

# Spark ML's deepest tree, and its split candidates per feature.
FOREST_DEPTH = 30
MAX_BINS = 64
# Megabytes of node statistics that a task holds in a pass over the data.
MOST_NODE_MB = 512

CAT_INDEX = "_tl_cat_idx"
CAT_VEC = "_tl_cat_vec"


def feature_stages(numeric: list[str], categorical: str = CATEGORICAL) -> list:
    """Numeric columns pass through; the category is one-hot encoded.

    Every category seen in training keeps its own slot (alphabetical order,
    as the reference's encoder orders them); an unseen category maps to the
    extra ``keep`` index, which ``dropLast`` turns into all zeros.
    """
    indexer = StringIndexer(
        inputCol=categorical, outputCol=CAT_INDEX, handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    encoder = OneHotEncoder(inputCols=[CAT_INDEX], outputCols=[CAT_VEC], dropLast=True)
    assembler = VectorAssembler(inputCols=numeric + [CAT_VEC], outputCol="features")
    return [indexer, encoder, assembler]


def forest_node_mb(max_depth: int) -> int:
    """Megabytes of node statistics that a task of a forest's pass holds.

    Every row updates a node of every tree in the pass.  The nodes of all trees
    at once are far larger than a processor's cache; some trees at a time stay
    in it, and the same nodes take more, shorter passes.  16 KB for each node of
    a full tree's deepest level keep the passes few for deep trees, too.  The
    trees do not depend on it.
    """
    return min(MOST_NODE_MB, max(4, 2**max_depth >> 6))


def make_regressor(name: str, label: str = TARGET, max_depth: int | None = None, max_bins: int = MAX_BINS):
    """A regressor by its display name.

    ``max_depth`` is a tree's deepest level: for the forest by default as deep
    as Spark ML grows trees (the reference's forest has no limit), for the
    boosted trees the boosting library's own default.  ``max_bins`` are the
    split candidates per feature.
    """
    shared = {"featuresCol": "features", "labelCol": label}
    if name == "Linear Regression":
        return LinearRegression(**shared)
    trees = shared | {"maxBins": max_bins, "seed": MODEL_SEED}
    if name == "Random Forest":
        # all features at every split, bootstrap rows, as the reference forest
        depth = max_depth or FOREST_DEPTH
        return RandomForestRegressor(
            numTrees=N_TREES, featureSubsetStrategy="all", maxDepth=depth, maxMemoryInMB=forest_node_mb(depth), **trees
        )
    if name == "Gradient Boosting":
        # a level of its one tree in one pass, however many features there are
        return GBTRegressor(
            maxIter=N_ROUNDS, maxDepth=max_depth or 6, stepSize=0.3, checkpointInterval=10, maxMemoryInMB=MOST_NODE_MB, **trees
        )
    raise ValueError(f"unknown model {name!r}")


def build_pipeline(name: str, numeric: list[str], categorical: str = CATEGORICAL, **settings) -> Pipeline:
    return Pipeline(stages=feature_stages(numeric, categorical) + [make_regressor(name, **settings)])


# Tree learners pass over the training data once per level and boosting round.
ROWS_PER_TRAIN_PARTITION = 500_000
# Fewer rows than these do not pay for a task of their own in every pass.
ROWS_WORTH_A_TASK = 1_000


def sized_for_training(train: DataFrame, rows_per_partition: int = ROWS_PER_TRAIN_PARTITION) -> DataFrame:
    """``train`` cached in one partition per so many rows, and in as many as the
    cluster runs at once wherever each still gets a thousand rows."""
    n = train.count()
    at_once = min(train.sparkSession.sparkContext.defaultParallelism, max(1, n // ROWS_WORTH_A_TASK))
    return train.repartition(max(at_once, -(-n // rows_per_partition))).persist()


def fit_model(name: str, train: DataFrame, numeric: list[str], **settings) -> PipelineModel:
    """Fit the pipeline; keep it with save_model() to use it again."""
    return fit_models({name: settings}, train, numeric)[name]


def fit_models(settings: dict[str, dict], train: DataFrame, numeric: list[str]) -> dict[str, PipelineModel]:
    """Fit a pipeline for each name on one cached table, all at the same time.

    Boosted trees are many short jobs one after another that leave the cluster
    idle in between; the other fits run in those gaps.
    """
    cached = sized_for_training(train)
    # with the caller's job group and other local properties
    fit = inheritable_thread_target(train.sparkSession)(lambda name: build_pipeline(name, numeric, **settings[name]).fit(cached))
    try:
        with ThreadPoolExecutor(max(1, len(settings))) as pool:
            return dict(zip(settings, pool.map(fit, settings)))
    finally:
        cached.unpersist()


def evaluate(pred: DataFrame, label: str = TARGET, prediction: str = "prediction", by: list[str] | None = None):
    """RMSE, MAE and R^2 (rounded to 4 dp) in one aggregate.

    R^2 = 1 - SSE / (n * var_pop(y)); ``var_pop`` is computed with merged
    central moments, so the whole metric is a single distributed pass.  R^2 of
    a constant target, and every metric of no rows, is NULL.
    """
    e = F.col(label) - F.col(prediction)
    n = F.count(F.lit(1)).cast("double")
    sse = F.sum(e * e)
    g = pred.groupBy(*by) if by else pred.groupBy()
    return g.agg(
        round_even(F.sqrt(F.try_divide(sse, n)), METRIC_DIGITS).alias("rmse"),
        round_even(F.avg(F.abs(e)), METRIC_DIGITS).alias("mae"),
        round_even(F.lit(1.0) - F.try_divide(sse, n * F.var_pop(label)), METRIC_DIGITS).alias("r2"),
    )


def baseline_predictions(split_df: DataFrame, label: str = TARGET, by_category: bool = True) -> DataFrame:
    """Mean-of-category baseline fitted on the train split, applied to test
    (unknown category -> mean of all training rows); without ``by_category``
    the mean of all training rows for every row."""
    train = split_df.where(F.col("split") == "train")
    test = split_df.where(F.col("split") == "test")
    total, n = F.sum(F.col(label).cast("decimal(38,4)")), F.count(label)
    # sums per category; the overall mean follows from them
    per = staged(train.groupBy(CATEGORICAL).agg(total.alias("_tl_sum"), n.alias("_tl_n")), "category-sums")
    mean = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    overall = per.agg(mean(F.sum("_tl_sum"), F.sum("_tl_n")).alias("m")).first()["m"]  # one scalar
    if not by_category:
        return test.withColumn("prediction", F.lit(overall).cast("double"))
    cat_mean = per.select(CATEGORICAL, mean(F.col("_tl_sum"), F.col("_tl_n")).alias("_tl_cat_mean"))
    scored = lookup_join(test, cat_mean, CATEGORICAL)
    return scored.withColumn("prediction", F.coalesce("_tl_cat_mean", F.lit(overall).cast("double"))).drop("_tl_cat_mean")


def predictions(model: PipelineModel, name: str, split_df: DataFrame) -> DataFrame:
    """``model`` applied to the test split."""
    scored = model.transform(split_df.where(F.col("split") == "test"))
    return scored.select("product_id", CATEGORICAL, TARGET, "prediction").withColumn("model", F.lit(name))


def compare_predictions(scored: DataFrame) -> DataFrame:
    """Metrics of every model in rows (model, target, prediction), one grouped
    aggregate, with the best flagged (lowest RMSE, ties by name)."""
    metrics = evaluate(scored, by=["model"])
    # one row per model: a window over the whole (tiny) metrics table
    first = F.row_number().over(Window.orderBy("rmse", "model")) == 1
    return metrics.select("model", "rmse", "mae", "r2", first.alias("is_best"))


def compare_models(models: dict[str, PipelineModel], split_df: DataFrame) -> DataFrame:
    """compare_predictions() of fitted models on the test split."""
    parts = [predictions(m, name, split_df).select("model", TARGET, "prediction") for name, m in models.items()]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return compare_predictions(scored)


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the lowest RMSE (ties by model name)."""
    return metrics.orderBy("rmse", "model").limit(1)


def save_model(model: PipelineModel, path: str, split: DataFrame | None = None) -> str:
    """Save the model and, beside it, the rows of the split it was fitted on."""
    model.write().overwrite().save(f"{path}/model")
    if split is not None:
        split.write.mode("overwrite").parquet(f"{path}/split")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/split")
