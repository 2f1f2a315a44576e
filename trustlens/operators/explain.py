"""Per-row, per-feature Shapley attributions and the tables built on them.

Two attribution jobs:

- ``shap_linear``: closed form beta_j * (x_j - mean_j) for a linear model.
- ``shap_sampled``: any fitted pipeline.  Each explained row is expanded
  (a generator, not a join) into hybrid feature vectors along P fixed
  permutations against the training set's mean row per category; the model
  scores all hybrids in one distributed ``transform``; every prediction adds
  +f to the feature that entered at its step and -f to the feature that enters
  next, and grouped sums give the attributions.  The sum over features equals
  prediction minus the weighted mean background prediction exactly.  Hybrids of
  linear models and trees are scored within the task that holds the row.

Long form ``(product_id, feature, feature_value, shap_value)`` is the
natural result; the wide export is a pivot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.scalar import exact_mean, truncate_label
from ..functions.staging import staged
from .features import CATEGORICAL

# Fixed values that must equal the reference's for right results: the
# feature-name prefixes of the transformed matrix, the SHAP column prefix,
# the number of top features / contributions shown, the title width.
NUM_PREFIX = "num__"
CAT_PREFIX = "cat__" + CATEGORICAL + "_"
SHAP_PREFIX = "shap_value_"
TOP_FEATURES = 7
TOP_CONTRIBUTIONS = 8
TITLE_WIDTH = 30

# Means are exact sums of values of so many decimals, whatever their order.
MEAN_SCALE = 9


def feature_names(model: PipelineModel, numeric: list[str]) -> list[str]:
    """Names of the transformed features: numerics, then one-hot slots in
    the encoder's (alphabetical) order."""
    labels = model.stages[0].labels
    return [NUM_PREFIX + c for c in numeric] + [CAT_PREFIX + v for v in labels]


def feature_names_df(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "feature_index int, feature string")


def _feature_model(model: PipelineModel) -> PipelineModel:
    return PipelineModel(stages=model.stages[:-1])


def dense_features(stages: PipelineModel, df: DataFrame) -> DataFrame:
    """product_id + dense feature array ``x`` made by fitted feature stages."""
    return stages.transform(df).select("product_id", vector_to_array("features").alias("x"))


def feature_arrays(model: PipelineModel, df: DataFrame) -> DataFrame:
    """dense_features() of a whole fitted pipeline."""
    return dense_features(_feature_model(model), df)


def _long(arr_df: DataFrame, names: list[str], shap_col: str, keep=None) -> DataFrame:
    """Explode aligned x / shap arrays into (product_id, feature, value, shap).

    ``keep`` takes a row's array of (s: shap, i: feature's place by name, j: its
    place, v: value) and leaves the entries that are needed."""
    name_arr = F.array(*[F.lit(n) for n in names])
    if keep is None:
        zipped = F.arrays_zip(F.col("x").alias("v"), F.col(shap_col).alias("s"))
        z = arr_df.select("product_id", F.posexplode(zipped).alias("feature_index", "p"))
    else:
        place = {n: i for i, n in enumerate(sorted(names))}
        by_name = F.array(*[F.lit(place[n]) for n in names])
        entry = lambda s, j: F.struct(s.alias("s"), by_name[j].alias("i"), j.alias("j"), F.col("x")[j].alias("v"))
        kept = keep(F.transform(shap_col, entry))
        z = arr_df.select("product_id", F.explode(kept).alias("p")).select("product_id", "p", F.col("p.j").alias("feature_index"))
    return z.select(
        "product_id",
        F.element_at(name_arr, F.col("feature_index") + 1).alias("feature"),
        F.col("p.v").alias("feature_value"),
        F.col("p.s").alias("shap_value"),
    )


def extremes(entries: Column) -> Column:
    """Of a row's entries for _long() those that product_explain() can show."""
    return F.array(F.array_max(entries), F.array_min(entries))


def largest(entries: Column, k: int = TOP_CONTRIBUTIONS) -> Column:
    """Of a row's entries for _long() those that top_contributions() can take."""
    ordered = F.transform(entries, lambda e: F.struct((-F.abs(e.s)).alias("by"), e.i.alias("i"), e.alias("e")))
    return F.transform(F.slice(F.array_sort(ordered), 1, k), lambda o: o.e)


#: Products of one task where a product's features are brought together.
PRODUCTS_AT_ONCE = 50_000


def by_product(arr: DataFrame, products: int = PRODUCTS_AT_ONCE) -> DataFrame:
    """Feature arrays in so many parts by product that a task groups some
    ``products`` of them, however large the table: the rows made of an array
    stay in its part, so grouping them by product moves nothing."""
    arr = staged(arr, "arrays")
    parts = max(arr.sparkSession.sparkContext.defaultParallelism, -(-arr.count() // products))
    return arr.repartition(parts, "product_id")


def background_summary(model: PipelineModel, train: DataFrame) -> list[tuple[list[float], int]]:
    """The training set as weighted rows: per category the mean feature vector
    and the number of rows.  As many rows as the model has category slots."""
    arr = _feature_model(model).transform(train).select(CATEGORICAL, vector_to_array("features").alias("x"))
    pos = arr.select(CATEGORICAL, F.posexplode("x").alias("j", "v"))
    mean = pos.groupBy(CATEGORICAL, "j").agg(exact_mean("v", MEAN_SCALE).alias("m"), F.count(F.lit(1)).alias("n"))
    rows = mean.groupBy(CATEGORICAL).agg(F.array_sort(F.collect_list(F.struct("j", "m"))).alias("x"), F.max("n").alias("n"))
    return [([p.m for p in r.x], r.n) for r in rows.orderBy(CATEGORICAL).collect()]


def background_mean(background: list[tuple[list[float], int]]) -> list[float]:
    """Mean feature vector of a background summary."""
    total = sum(n for _, n in background)
    return [sum(x[j] * n for x, n in background) / total for j in range(len(background[0][0]))]


def feature_means(arr: DataFrame, k: int) -> list[float]:
    """Exact means of the k entries of the feature arrays ``x``."""
    row = arr.agg(*[exact_mean(F.col("x")[i], MEAN_SCALE).alias(f"m{i}") for i in range(k)]).first()
    return [float(v) for v in row]


def linear_attributions(arr: DataFrame, names: list[str], beta: list[float], mean: list[float], keep=None) -> DataFrame:
    """beta_j (x_j - mean_j) for every row of ``arr`` (product_id, x)."""
    b, m = (F.array(*[F.lit(float(v)) for v in x]) for x in (beta, mean))
    return _long(arr.withColumn("_tl_shap", F.transform("x", lambda x, i: (x - m[i]) * b[i])), names, "_tl_shap", keep)


def shap_linear(model: PipelineModel, data: DataFrame, background: DataFrame, numeric: list[str], keep=None) -> DataFrame:
    """Exact Shapley values of a linear model against the whole background."""
    beta = [float(b) for b in model.stages[-1].coefficients.toArray()]
    mean = feature_means(feature_arrays(model, background), len(beta))
    return linear_attributions(feature_arrays(model, data), feature_names(model, numeric), beta, mean, keep)


def permutations(k: int, n_perm: int, seed: int = 42) -> list[list[int]]:
    """``n_perm`` permutations of k features, antithetic pairs (a perm and
    its reverse), fixed by ``seed`` so reruns agree."""
    rng = np.random.default_rng(seed)
    out: list[list[int]] = []
    while len(out) < n_perm:
        p = [int(v) for v in rng.permutation(k)]
        out.append(p)
        if len(out) < n_perm:
            out.append(p[::-1])
    return out


def shap_sampled(
    model: PipelineModel,
    data: DataFrame,
    train: DataFrame,
    numeric: list[str],
    n_perm: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Sampled-permutation Shapley values for any fitted pipeline, against the
    whole training set summarised by background_summary().

    Along a permutation only features that differ between the row and the
    background row can change the prediction, so only these make a step: at
    most the numeric ones and two category slots, however many categories
    there are.  ``std_error`` is that of the mean over the permutations.

    Linear models and trees are scored in the task that holds the row, so
    hybrids are neither moved nor kept; any other model scores them as rows.
    """
    names = feature_names(model, numeric)
    background = background_summary(model, train)
    if not background:
        raise ValueError("empty training set")
    total = sum(n for _, n in background)
    along = _scorer(model, np.array([x for x, _ in background]), np.array([n / total for _, n in background]), permutations(len(names), n_perm, seed))
    if along is not None:
        return _sampled_in_tasks(feature_arrays(model, data), names, along, n_perm)
    doubles = lambda xs: F.array(*[F.lit(float(v)) for v in xs])
    perms = permutations(len(names), n_perm, seed)
    perm_lit = F.array(*[F.array(*[F.lit(v) for v in p]) for p in perms])
    bg = F.array(*[F.struct(doubles(x).alias("z"), F.lit(n / total).alias("w")) for x, n in background])

    arr = feature_arrays(model, data)
    runs = arr.select("product_id", "x", F.explode(bg).alias("b")).select("product_id", "x", "b.z", "b.w")
    runs = runs.select("*", F.posexplode(perm_lit).alias("perm", "order"))
    active = F.filter("order", lambda j: F.col("x")[j] != F.col("z")[j])
    runs = runs.select("product_id", "x", "z", "w", "perm", active.alias("steps"))
    runs = runs.withColumn("t", F.explode(F.sequence(F.lit(0), F.size("steps"))))
    taken = F.slice("steps", F.lit(1), F.col("t"))
    hybrid = F.transform("x", lambda v, j: F.when(F.array_contains(taken, j), v).otherwise(F.col("z")[j]))
    scored = model.stages[-1].transform(runs.withColumn("features", array_to_vector(hybrid)))
    f, t, steps = F.col("prediction") * F.col("w"), F.col("t"), F.col("steps")
    plus = F.when(t >= 1, F.struct(F.get(steps, t - 1).alias("j"), f.alias("v")))
    minus = F.when(t < F.size(steps), F.struct(F.get(steps, t).alias("j"), (-f).alias("v")))
    moved = scored.select(
        "product_id", "perm", F.explode(F.filter(F.array(plus, minus), lambda c: c.isNotNull())).alias("c")
    ).select("product_id", "perm", "c.j", "c.v")
    # a feature that never made a step has the value 0 in every permutation
    every = arr.select("product_id", F.explode(F.sequence(F.lit(0), F.lit(len(perms) - 1))).alias("perm"), "x")
    every = every.select("product_id", "perm", F.posexplode("x").alias("j", "value"))
    both = moved.select("*", F.lit(None).cast("double").alias("value")).unionByName(every.withColumn("v", F.lit(0.0)))
    per = both.groupBy("product_id", "j", "perm").agg(F.sum("v").alias("phi"), F.max("value").alias("value"))
    name_arr = F.array(*[F.lit(n) for n in names])
    return per.groupBy("product_id", "j").agg(
        F.avg("phi").alias("shap_value"),
        (F.stddev_samp("phi") / F.lit(float(len(perms)) ** 0.5)).alias("std_error"),
        F.max("value").alias("feature_value"),
    ).select(
        "product_id",
        F.element_at(name_arr, F.col("j") + 1).alias("feature"),
        "feature_value",
        "shap_value",
        "std_error",
    )


def _scorer(model: PipelineModel, z: np.ndarray, weight: np.ndarray, perms: list[list[int]]):
    """What gives, for rows x, their steps' sums [perm * k + feature, row]
    against the background rows ``z``; None for models not known here."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        beta, intercept = last.coefficients.toArray(), float(last.intercept)
        return lambda x: _linear_steps(x, z, weight, perms, beta, intercept)
    if hasattr(last, "treeWeights"):
        from . import tree_shap as trees  # builds on this module

        sent = SparkSession.active().sparkContext.broadcast(trees.as_trees(trees.tree_nodes(model).collect()))
        return lambda x: trees.tree_steps(sent.value, x, z, weight, perms)
    return None


def _linear_steps(x: np.ndarray, z: np.ndarray, weight: np.ndarray, perms: list[list[int]], beta: np.ndarray, intercept: float) -> np.ndarray:
    k = len(beta)
    out = np.zeros((len(perms) * k, len(x)))
    for start in range(0, len(x), 10_000):
        rows = x[start : start + 10_000]
        for row, w in zip(z, weight):
            differs = rows != row
            for p, perm in enumerate(perms):
                hybrid = np.repeat(row[None, :], len(rows), 0)
                before = hybrid @ beta + intercept
                for j in perm:
                    if differs[:, j].any():
                        hybrid[:, j] = rows[:, j]
                        now = hybrid @ beta + intercept
                        out[p * k + j, start : start + len(rows)] += w * (now - before)
                        before = now
    return out


def _sampled_in_tasks(arr: DataFrame, names: list[str], along, n_perm: int) -> DataFrame:
    """shap_sampled() with ``along`` of _scorer(); the rows of one product_id
    are added up."""
    from .tree_shap import dealt, held, vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in held(batches):
            groups = b.column("xs")
            first = groups.offsets.to_numpy()[:-1] - groups.offsets[0].as_py()
            x = vectors(groups.flatten())
            steps = np.add.reduceat(along(x), first, axis=1).reshape(n_perm, len(names), len(groups))
            error = steps.std(0, ddof=1) / n_perm**0.5 if n_perm > 1 else None
            columns = [np.maximum.reduceat(x, first, axis=0).T, steps.mean(0), error]
            ends = pa.array(np.arange(0, len(groups) * len(names) + 1, len(names)), pa.int32())
            lists = [pa.nulls(len(groups), pa.list_(pa.float64())) if c is None else pa.ListArray.from_arrays(ends, pa.array(c.T.ravel())) for c in columns]
            whole = pa.RecordBatch.from_arrays([b.column("product_id"), *lists], names=["product_id", "x", "phi", "error"])
            for start in range(0, whole.num_rows, 10_000):
                yield whole.slice(start, 10_000)

    rows = dealt(arr.groupBy("product_id").agg(F.collect_list("x").alias("xs")))
    found = rows.mapInArrow(run, "product_id string, x array<double>, phi array<double>, error array<double>")
    name_arr = F.array(*[F.lit(n) for n in names])
    j = F.posexplode("x").alias("j", "feature_value")
    return found.select("product_id", "phi", "error", j).select(
        "product_id",
        F.element_at(name_arr, F.col("j") + 1).alias("feature"),
        "feature_value",
        F.get("phi", F.col("j")).alias("shap_value"),
        F.get("error", F.col("j")).alias("std_error"),
    )


def shap_importance(shap_long: DataFrame) -> DataFrame:
    """Mean |SHAP| per feature (order: importance desc, then name)."""
    return shap_long.groupBy("feature").agg(exact_mean(F.abs("shap_value"), MEAN_SCALE).alias("importance"))


def top_features(importance: DataFrame, k: int = TOP_FEATURES) -> DataFrame:
    return importance.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def shap_wide(shap_long: DataFrame, names: list[str]) -> DataFrame:
    """Export form: product_id, one value and one ``shap_value_`` column per
    feature.  The pivot values are given, so no distinct-values job runs."""
    vals = shap_long.groupBy("product_id").pivot("feature", names).agg(
        F.first("feature_value").alias("v"), F.first("shap_value").alias("s")
    )
    cols = [F.col(f"`{n}_v`").alias(n) for n in names] + [F.col(f"`{n}_s`").alias(SHAP_PREFIX + n) for n in names]
    return vals.select("product_id", *cols)


def shap_long(wide: DataFrame) -> DataFrame:
    """Rows (product_id, feature, feature_value, shap_value) of a wide export:
    every ``shap_value_`` column with the column it explains."""
    names = [c.removeprefix(SHAP_PREFIX) for c in wide.columns if c.startswith(SHAP_PREFIX)]
    pairs = [F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").alias("v"), F.col(f"`{SHAP_PREFIX}{n}`").alias("s")) for n in names]
    rows = wide.select("product_id", F.explode(F.array(*pairs)).alias("p"))
    return rows.select("product_id", "p.feature", F.col("p.v").alias("feature_value"), F.col("p.s").alias("shap_value"))


def top_contributions(shap_long: DataFrame, k: int = TOP_CONTRIBUTIONS) -> DataFrame:
    """Per product, the k features with the largest |SHAP|, with direction.

    A per-product window: groups are one product's features (bounded by the
    feature count), never a category or the whole table.
    """
    w = Window.partitionBy("product_id").orderBy(F.desc(F.abs("shap_value")), F.asc("feature"))
    ranked = shap_long.withColumn("contribution_rank", F.row_number().over(w))
    return ranked.where(F.col("contribution_rank") <= k).withColumn(
        "direction", F.when(F.col("shap_value") >= 0, F.lit("up")).otherwise(F.lit("down"))
    )


def shap_dependence(shap_long: DataFrame, bins: int = 20) -> DataFrame:
    """Per feature: mean SHAP value in equal-width bins of the feature value
    (the dependence scatter, binned so it scales)."""
    rng = shap_long.groupBy("feature").agg(F.min("feature_value").alias("_lo"), F.max("feature_value").alias("_hi"))
    j = lookup_join(shap_long, rng, "feature", "inner")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("feature_value") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return j.groupBy("feature", b.cast("int").alias("value_bin")).agg(
        F.count(F.lit(1)).alias("n"),
        exact_mean("feature_value", MEAN_SCALE).alias("mean_feature_value"),
        exact_mean("shap_value", MEAN_SCALE).alias("mean_shap_value"),
    )


def default_labels(spark, names: list[str], own: dict[str, str] | None = None) -> DataFrame:
    """Display label per feature: the caller's for the column, else the column
    name with spaces; "category: <name>" for one-hot slots."""
    rows = []
    for n in names:
        if n.startswith(NUM_PREFIX):
            column = n[len(NUM_PREFIX):].removeprefix("log_")
            rows.append((n, (own or {}).get(column, column.replace("_", " "))))
        elif n.startswith(CAT_PREFIX):
            rows.append((n, "category: " + n[len(CAT_PREFIX):]))
    return spark.createDataFrame(rows, "feature string, label string")


def label_features(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach a display label, falling back to the raw feature name."""
    j = lookup_join(df, labels, "feature")
    return j.withColumn("label", F.coalesce(F.col("label"), F.col("feature")))


def product_labels(products: DataFrame, width: int = TITLE_WIDTH) -> DataFrame:
    """``id | name`` option label and a title cut to ``width`` chars + ``...``."""
    return products.select(
        "product_id",
        F.concat_ws(" | ", "product_id", "product_name").alias("option_label"),
        truncate_label(F.col("product_name"), width).alias("short_title"),
    )


def product_explain(products: DataFrame, shap_long: DataFrame) -> DataFrame:
    """Per product: profile plus its largest positive and negative factor."""
    per = shap_long.groupBy("product_id").agg(
        F.max_by(F.struct("feature", "feature_value", "shap_value"), F.struct("shap_value", "feature")).alias("up"),
        F.min_by(F.struct("feature", "feature_value", "shap_value"), F.struct("shap_value", "feature")).alias("down"),
    )
    prof = products.select("product_id", "product_name", CATEGORICAL, "rating", "rating_count", "bayesian_rating")
    return prof.join(per, "product_id", "inner").select(
        "product_id",
        "product_name",
        CATEGORICAL,
        "rating",
        "rating_count",
        "bayesian_rating",
        F.col("up.feature").alias("top_positive_feature"),
        F.col("up.feature_value").alias("top_positive_value"),
        F.col("up.shap_value").alias("top_positive_shap"),
        F.col("down.feature").alias("top_negative_feature"),
        F.col("down.feature_value").alias("top_negative_value"),
        F.col("down.shap_value").alias("top_negative_shap"),
    )
