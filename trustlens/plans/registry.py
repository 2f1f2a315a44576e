"""Registered queries (Spark) and their DuckDB twins.

Every query reads the driver tables under ``sf_dir`` and derives the
product catalogue from them, so its work grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean as C
from ..operators import explain as X
from ..operators import features as FE
from ..operators import model as M
from ..operators import gold as GO
from ..operators import guide as G
from ..operators import profile as P
from ..operators import sketches as SK
from ..operators import tree_shap as TS
from ..operators import trust as T
from ..functions.joins import lookup_join
from ..functions.staging import staged
from ..functions.stats import group_quantiles, value_counts
from ..sources import fixtures as FX
from . import oracle as O
from ..sources import io as IO
from ..sources import keyed as K
from ..sources import split_csv as SC
from ..sources import zip_source as ZS
from . import pipeline as PL
from .session import scratch_dir

# Thresholds used by the registered queries: the reference's 15 and a second,
# coarser 80 that leaves a large ``Other`` group (see FIXTURES.md).
THRESHOLD = 15
THRESHOLD_COARSE = 80
# The caller's text for each verdict of the purchase guide.
MESSAGES = {
    "success": "falls by less than 0.1",
    "warning": "falls by less than 0.3",
    "error": "falls by 0.3 or more",
}

# Coefficients planted for the attribution queries, so that SQL can state the
# result: numeric feature i, and category slot i in alphabetical order.
def planted(i: int, numeric: bool) -> float:
    return (i + 1) / 8 if numeric else (i % 7 - 3) / 16


# Settings of the registered fits.  200 trees as deep as Spark grows them take
# minutes on a small machine, so the registered forest stops at depth 8; the
# operator itself has no such limit.
SETTINGS = {"Random Forest": {"max_depth": 8}}

# Text of one file of the split listing; its tasks read 128 MB or less each.
SPLIT_FILE_BYTES = 256 << 20

_MODELS: dict[tuple, str] = {}


def _models(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple[dict[str, PipelineModel], PL.ModelInputs]:
    """The models of these names for the input as it is now: fitted together and
    saved with their split once, loaded from their paths after that."""
    version = FX.input_version(spark, sf_dir)
    key = lambda name: (spark.sparkContext.applicationId, version, name)
    mi = PL.model_inputs(spark, sf_dir)
    if missing := {name: SETTINGS.get(name, {}) for name in names if key(name) not in _MODELS}:
        for name, model in M.fit_models(missing, mi.split.where("split = 'train'"), mi.numeric).items():
            _MODELS[key(name)] = M.save_model(model, scratch_dir(spark, "model"), mi.split)
    return {name: M.load_model(_MODELS[key(name)]) for name in names}, mi


def _model(spark: SparkSession, sf_dir: str, name: str) -> tuple[PipelineModel, PL.ModelInputs]:
    models, mi = _models(spark, sf_dir, [name])
    return models[name], mi


QueryFn = Callable[[SparkSession, str], DataFrame]


def _clean(spark: SparkSession, sf_dir: str, threshold: int = THRESHOLD) -> DataFrame:
    # not cached: every query prunes it to the columns that it needs
    return C.clean_products(FX.staged_products_raw(spark, sf_dir), threshold)


def _narrow(spark: SparkSession, sf_dir: str, threshold: int = THRESHOLD) -> DataFrame:
    return PL.narrow_clean(spark, sf_dir, threshold)


def _detail(spark: SparkSession, sf_dir: str, threshold: int = THRESHOLD) -> DataFrame:
    return T.trust_detail(_narrow(spark, sf_dir, threshold))


def build_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}

    q["products_raw"] = lambda s, d: FX.products_raw(s, d)
    q["clean_products"] = lambda s, d: _clean(s, d)
    q["clean_products_t80"] = lambda s, d: _clean(s, d, THRESHOLD_COARSE)
    q["category_params"] = lambda s, d: T.category_params(_narrow(s, d)).drop("category_mean_exact")
    q["category_params_t80"] = lambda s, d: T.category_params(_narrow(s, d, THRESHOLD_COARSE)).drop(
        "category_mean_exact"
    )
    q["trust_rating"] = lambda s, d: T.trust_rating(_clean(s, d))
    q["trust_detail"] = lambda s, d: _detail(s, d)
    q["rank_movers_top50"] = lambda s, d: T.rank_movers_top(_detail(s, d), 50)
    q["rank_movers_top50_t80"] = lambda s, d: T.rank_movers_top(_detail(s, d, THRESHOLD_COARSE), 50)

    # cleaning steps, one query each
    def raw(s, d):
        return FX.staged_products_raw(s, d)

    q["parse_money"] = lambda s, d: raw(s, d).select(
        "ordinal",
        F.col("actual_price").alias("actual_price_text"),
        S.parse_money("actual_price").alias("actual_price"),
        F.col("discounted_price").alias("discounted_price_text"),
        S.parse_money("discounted_price").alias("discounted_price"),
    )
    q["parse_percent"] = lambda s, d: raw(s, d).select(
        "ordinal",
        F.col("discount_percentage").alias("discount_percentage_text"),
        S.parse_percent("discount_percentage").alias("discount_percentage"),
    )
    q["parse_count"] = lambda s, d: raw(s, d).select(
        "ordinal",
        F.col("rating_count").alias("rating_count_text"),
        S.parse_count("rating_count").alias("rating_count"),
    )
    q["parse_numeric"] = lambda s, d: raw(s, d).select(
        "ordinal", F.col("rating").alias("rating_text"), S.parse_numeric("rating").alias("rating")
    )
    q["category_level"] = lambda s, d: raw(s, d).select(
        "ordinal", "category", S.category_level("category", 1).alias("second_category")
    )
    q["dedup_first"] = lambda s, d: C.dedup_first(C.valid_listings(C.parse_listings(raw(s, d)))).select(
        "product_id", "ordinal"
    )

    def bucketed(s, d):
        first = C.dedup_first(C.valid_listings(C.parse_listings(raw(s, d))))
        lv = first.withColumn("second_category", S.category_level("category", 1))
        return C.bucket_rare(lv, "second_category", "main_category", THRESHOLD)

    q["bucket_rare"] = lambda s, d: bucketed(s, d).select("product_id", "second_category", "main_category")
    q["review_length"] = lambda s, d: _clean(s, d).select("product_id", "review_length")
    q["category_counts"] = lambda s, d: P.category_counts(_clean(s, d))
    q["align_schema"] = lambda s, d: C.align_schema(FX.products_dummy(s, d))
    q["allowed_categories"] = lambda s, d: C.allowed_categories(_clean(s, d))
    q["conform_domain"] = lambda s, d: C.conform_domain(
        C.align_schema(FX.products_dummy(s, d)), C.allowed_categories(_clean(s, d))
    ).select("product_id", "main_category")
    q["seed_domain"] = lambda s, d: C.conformed_dummy(FX.products_dummy(s, d), _clean(s, d))

    def domain(s, d):
        clean = _clean(s, d)
        return C.domain_check(clean, C.conformed_dummy(FX.products_dummy(s, d), clean))

    q["domain_check"] = domain

    # trust outputs
    q["m_values"] = lambda s, d: T.m_values(_narrow(s, d))

    def approx_m(s, d):
        clean = _narrow(s, d)
        near = group_quantiles(clean, ["main_category"], "rating_count", [0.2, 0.3], ["low", "high"])
        both = lookup_join(T.m_values_approx(clean), near, "main_category")
        within = F.col("m_value_approx").between(F.col("low"), F.col("high"))
        return both.select("main_category", "product_count", within.alias("near_first_quartile"))

    q["m_values_approx"] = approx_m
    q["m_extremes"] = lambda s, d: T.m_extremes(_narrow(s, d))
    q["trust_summary"] = lambda s, d: T.trust_summary(_detail(s, d))
    q["trust_summary_t80"] = lambda s, d: T.trust_summary(_detail(s, d, THRESHOLD_COARSE))
    q["m_choice_compare"] = lambda s, d: T.m_choice_compare(_narrow(s, d))

    # purchase guide
    def scored(s, d):
        clean = _narrow(s, d)
        return G.score_candidates(FX.candidates(clean), T.category_params(clean), MESSAGES)

    def compared(s, d):
        clean = _narrow(s, d)
        cands = FX.candidates(clean)
        return G.compare_pairs(FX.pairs(cands), cands, T.category_params(clean))

    q["score_candidates"] = scored
    q["compare_pairs"] = compared

    # profiles
    q["kpis"] = lambda s, d: P.kpis(_clean(s, d))

    def approx_kpis(s, d):
        clean = _narrow(s, d)
        exact = P.kpis(clean).first()
        near = lambda c: (F.abs(F.col(f"{c}_approx") - exact[c]) <= 0.05 * exact[c]).alias(f"{c}_near")
        return P.kpis_approx(clean).select(near("distinct_products"), near("distinct_categories"))

    q["kpis_approx"] = approx_kpis
    q["review_quintile"] = lambda s, d: P.review_quintile(_clean(s, d)).select(
        "product_id", "rating_count", "review_rank", "quintile", "review_count_group"
    )
    q["quintile_summary"] = lambda s, d: P.quintile_summary(_narrow(s, d))
    q["extremes_compare"] = lambda s, d: P.extremes_compare(_narrow(s, d))
    q["category_profile"] = lambda s, d: P.category_profile(_narrow(s, d))
    q["histogram15"] = lambda s, d: P.histogram15(_narrow(s, d))
    q["box_stats_quintile"] = lambda s, d: P.box_stats_quintile(_narrow(s, d))
    q["box_stats_category"] = lambda s, d: P.box_stats_category(_narrow(s, d))
    q["box_stats_extremes"] = lambda s, d: P.box_stats_extremes(_narrow(s, d))
    q["funnel_grid"] = lambda s, d: P.funnel_grid(_narrow(s, d))
    q["preview_sample"] = lambda s, d: P.preview_sample(T.trust_rating(_clean(s, d)))

    # features
    q["skew_report"] = lambda s, d: FE.skew_report(_clean(s, d))

    def logged_long(s, d):
        clean = _clean(s, d)
        logged = FE.log_features(clean)
        cols = [c for c in logged.columns if c.startswith("log_")]
        return FE.to_long(logged, ["product_id"], cols)

    q["log_features"] = logged_long

    def missing(s, d):
        mi = PL.model_inputs(s, d)
        return FE.missing_report(mi.features, mi.numeric + [FE.CATEGORICAL])

    q["missing_report"] = missing

    def feats_long(s, d):
        mi = PL.model_inputs(s, d)
        return FE.to_long(mi.features, ["product_id", FE.CATEGORICAL], mi.numeric)

    q["feature_table"] = feats_long

    def ready_long(s, d):
        mi = PL.model_inputs(s, d)
        return FE.to_long(mi.ready, ["product_id", FE.CATEGORICAL, FE.TARGET], mi.numeric)

    q["model_ready"] = ready_long

    def audit(s, d):
        mi = PL.model_inputs(s, d)
        return FE.join_audit(mi.features, mi.trust)

    q["join_audit"] = audit
    q["split_assign"] = lambda s, d: FE.split_assign(_clean(s, d).select("product_id")).select("product_id", "split")
    q["evaluate_baseline"] = lambda s, d: M.evaluate(M.baseline_predictions(PL.target_split(s, d)))

    # models: SQL states what must hold of them
    def fitted(name):
        def run(s, d):
            model, mi = _model(s, d, name)
            test = F.col("split") == "test"
            error = F.when(~test, (F.col(FE.TARGET) - F.col("prediction")) ** 2)
            return model.transform(mi.split).agg(
                F.lit(name).alias("model"),
                F.count_if(test).alias("test_rows"),
                F.count_if(test & F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted_rows"),
                (F.avg(error) < F.var_pop(F.when(~test, F.col(FE.TARGET)))).alias("fits_better_than_mean"),
            )

        return run

    q["fit_linear"] = fitted("Linear Regression")
    q["fit_forest"] = fitted("Random Forest")

    def normal_equations(s, d):
        """A least-squares fit leaves residuals at right angles to every column
        it was fitted on, the constant one too; no other fit does."""
        model, mi = _model(s, d, "Linear Regression")
        train = mi.split.where("split = 'train'")
        rows = model.transform(train).select((F.col(FE.TARGET) - F.col("prediction")).alias("e"), vector_to_array("features").alias("x"))
        names = [*X.feature_names(model, mi.numeric), "intercept"]
        columns = F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("j", "v")
        long = rows.select("e", columns)
        angle = F.abs(F.sum(F.col("e") * F.col("v"))) / F.sqrt(F.sum(F.col("e") * F.col("e")) * F.sum(F.col("v") * F.col("v")))
        name = F.element_at(F.array(*(F.lit(n) for n in names)), F.col("j") + 1)
        return long.groupBy("j").agg(angle.alias("angle")).select(name.alias("feature"), (F.col("angle") < 1e-4).alias("holds"))

    q["linear_normal_equations"] = normal_equations
    q["fit_boosted"] = fitted("Gradient Boosting")

    def all_models(s, d):
        return _models(s, d, M.MODEL_NAMES)

    def compare(s, d):
        models, mi = all_models(s, d)
        metrics = M.compare_models(models, mi.split)
        least = F.min_by("is_best", "rmse")
        return metrics.agg(
            F.count(F.lit(1)).alias("models"),
            F.count_if("is_best").alias("best"),
            least.alias("best_has_least_rmse"),
            (F.count("rmse") + F.count("mae") + F.count("r2")).alias("metrics"),
        )

    q["compare_models"] = compare

    def best_of_baselines(s, d):
        split = PL.target_split(s, d)
        parts = [
            M.baseline_predictions(split, by_category=c).select(F.lit(n).alias("model"), FE.TARGET, "prediction")
            for n, c in (("Category Mean", True), ("Overall Mean", False))
        ]
        return M.best_model(M.compare_predictions(parts[0].unionByName(parts[1])))

    q["best_model"] = best_of_baselines

    def sampled(name):
        def run(s, d):
            model, mi = _model(s, d, name)
            train = mi.split.where("split = 'train'")
            shap = X.shap_sampled(model, mi.split, train, mi.numeric, n_perm=2)
            background = X.background_summary(model, train)
            total = sum(n for _, n in background)
            rows = s.createDataFrame([(x, n / total) for x, n in background], "x array<double>, w double")
            at = model.stages[-1].transform(rows.withColumn("features", array_to_vector("x")))
            base = at.agg(F.sum(F.col("prediction") * F.col("w"))).first()[0]
            sums = shap.groupBy("product_id").agg(F.sum("shap_value").alias("phi"), F.count(F.lit(1)).alias("n"))
            both = model.transform(mi.split).select("product_id", "prediction").join(sums, "product_id")
            return both.agg(
                F.count(F.lit(1)).alias("products"),
                F.max("n").alias("features"),
                (F.max(F.abs(F.col("phi") - (F.col("prediction") - F.lit(base)))) < 1e-9).alias("adds_up"),
            )

        return run

    q["shap_sampled"] = sampled("Linear Regression")
    q["shap_sampled_forest"] = sampled("Random Forest")

    def exact(name):
        """What must hold of exact attributions against the training set."""

        def run(s, d):
            model, mi = _model(s, d, name)
            rows = mi.split
            train = rows.where("split = 'train'")
            shap = TS.shap_exact(model, rows, train, mi.numeric)
            base = model.transform(train).agg(F.avg("prediction")).first()[0]  # one scalar
            sums = shap.groupBy("product_id").agg(F.sum("shap_value").alias("phi"), F.count(F.lit(1)).alias("n"))
            both = model.transform(rows).select("product_id", "prediction").join(sums, "product_id")
            return both.agg(
                F.count(F.lit(1)).alias("products"),
                F.max("n").alias("features"),
                (F.max(F.abs(F.col("phi") - (F.col("prediction") - F.lit(base)))) < 1e-8).alias("adds_up"),
            )

        return run

    q["shap_forest"] = exact("Random Forest")
    q["shap_boosted"] = exact("Gradient Boosting")

    # from the fitted models to what the best of them goes by
    q["model_metrics"] = lambda s, d: (lambda models, mi: M.compare_models(models, mi.split))(*all_models(s, d))

    def best_attributions(s, d, keep=None):
        models, mi = all_models(s, d)
        rows = mi.split
        best = M.best_model(M.compare_models(models, rows)).first()["model"]  # one name
        return best, TS.shap_exact(models[best], rows, rows.where("split = 'train'"), mi.numeric, keep), mi

    def best_importance(s, d):
        best, shap, _ = best_attributions(s, d)
        return X.top_features(X.shap_importance(shap)).withColumn("model", F.lit(best))

    def best_explained(s, d):
        _, shap, mi = best_attributions(s, d, X.extremes)
        return X.product_explain(mi.trust, shap)

    q["best_model_importance"] = best_importance
    q["best_model_explain"] = best_explained
    q["best_model_contributions"] = lambda s, d: X.top_contributions(best_attributions(s, d, X.largest)[1])
    q["best_model_dependence"] = lambda s, d: X.shap_dependence(staged(best_attributions(s, d)[1], "best-shap"))

    def features_and_names(s, d):
        mi = PL.model_inputs(s, d)
        stages = Pipeline(stages=M.feature_stages(mi.numeric)).fit(mi.split.where("split = 'train'"))
        return stages, X.feature_names(stages, mi.numeric), mi

    def linear_shap(s, d, together=False):
        stages, names, mi = features_and_names(s, d)
        k = len(mi.numeric)
        beta = [planted(i, True) for i in range(k)] + [planted(i, False) for i in range(len(names) - k)]
        mean = X.feature_means(X.dense_features(stages, mi.split.where("split = 'train'")), len(names))
        arr = X.dense_features(stages, mi.split)
        return X.linear_attributions(X.by_product(arr) if together else arr, names, beta, mean), names, mi

    q["feature_names"] = lambda s, d: X.feature_names_df(s, features_and_names(s, d)[1])
    q["shap_linear"] = lambda s, d: linear_shap(s, d)[0]
    q["shap_importance"] = lambda s, d: X.shap_importance(linear_shap(s, d)[0])
    q["top_features"] = lambda s, d: X.top_features(X.shap_importance(linear_shap(s, d)[0]))
    q["top_features5"] = lambda s, d: X.top_features(X.shap_importance(linear_shap(s, d)[0]), 5)

    def wide(s, d):
        sl, names, _ = linear_shap(s, d, together=True)
        # every feature under its place in feature_names
        places = range(len(names))
        return X.shap_wide(sl, names).toDF("product_id", *[f"value_{i}" for i in places], *[f"shap_{i}" for i in places])

    q["shap_wide"] = wide
    q["shap_long"] = lambda s, d: (lambda sl, names, _: X.shap_long(X.shap_wide(sl, names)))(*linear_shap(s, d, together=True))
    q["top_contributions"] = lambda s, d: X.top_contributions(linear_shap(s, d)[0])
    q["shap_dependence"] = lambda s, d: X.shap_dependence(linear_shap(s, d)[0])

    def labelled(s, d):
        sl, names, _ = linear_shap(s, d)
        return X.label_features(X.shap_importance(sl), X.default_labels(s, names))

    q["label_features"] = labelled

    def explained(s, d):
        sl, _, mi = linear_shap(s, d)
        return X.product_explain(mi.trust, sl)

    q["product_explain"] = explained
    q["product_labels"] = lambda s, d: X.product_labels(_clean(s, d))

    # sources and sinks (round trips through the shared scratch folder)
    def listings_roundtrip(s, d):
        path = IO.write_csv(FX.products_raw(s, d), scratch_dir(s, "listings_csv"))
        return IO.read_listings(s, path).select(*FX.RAW_COLUMNS)

    q["read_listings"] = listings_roundtrip

    def numbered_listings(s, d):
        raw_rows = IO.in_files(raw(s, d), "ordinal", least=5)
        path = IO.write_csv(raw_rows.drop("ordinal"), scratch_dir(s, "listings_parts"), bom=True)
        return IO.read_listings(s, path).select(*FX.RAW_COLUMNS)

    q["read_listings_numbered"] = numbered_listings

    def zipped(s, d):
        archives = IO.zip_listings(FX.products_raw(s, d), scratch_dir(s, "listings_zip"))
        return IO.read_listings(s, IO.unzip_listings(s, archives, scratch_dir(s, "unzipped"))).select(*FX.RAW_COLUMNS)

    q["read_zip"] = zipped

    def zip_members(s, d):
        archives = IO.zip_listings(FX.products_raw(s, d), scratch_dir(s, "listings_zip"))
        return ZS.read_zip_listings(s, archives, list(FX.RAW_COLUMNS))

    q["read_zip_members"] = zip_members

    def split_listings(s, d):
        # one file as long as one task can write it, then files of that size:
        # each is cut into ranges that tasks of their own read
        raw_rows = IO.in_files(raw(s, d), "ordinal", file_bytes=SPLIT_FILE_BYTES)
        path = IO.write_csv(raw_rows.drop("ordinal"), scratch_dir(s, "one_listing"), bom=True)
        return SC.read_split_csv(s, path).select(*FX.RAW_COLUMNS)

    q["read_listings_split"] = split_listings

    def table_roundtrip(s, d):
        path = IO.write_table(T.trust_rating(_clean(s, d)), scratch_dir(s, "products_trust"))
        return IO.read_table(s, path)

    q["write_table"] = table_roundtrip

    def gold(s, d):
        clean = _clean(s, d)
        params = T.category_params(clean)
        paths = IO.materialize(
            {"products_clean": clean, "category_params": params, "products_trust": T.trust_rating(clean, params)},
            scratch_dir(s, "gold"),
        )
        # what the written tables hold, as a sum over a hash of each row's key
        # and one value
        content = {
            "products_clean": ["product_id", "main_category"],
            "category_params": ["main_category", F.rint(F.col("m_value") * 10).cast("long").cast("string")],
            "products_trust": ["product_id", F.rint(F.col("bayesian_rating") * 10000).cast("long").cast("string")],
        }
        parts = []
        for name, path in paths.items():
            digest = F.conv(F.substring(F.md5(F.concat_ws("|", *content[name])), 1, 8), 16, 10).cast("long")
            sums = IO.read_table(s, path).agg(F.count(F.lit(1)).alias("row_count"), F.sum(digest).alias("content_sum"))
            parts.append(sums.withColumn("table_name", F.lit(name)))
        out = parts[0]
        for p_ in parts[1:]:
            out = out.unionByName(p_)
        return out.select("table_name", "row_count", "content_sum")

    q["materialize_gold"] = gold

    def refreshed(s, d):
        """Two thirds and more at first; a refresh takes some products out and
        puts the others in."""
        rows = raw(s, d)
        key = F.col("product_id").cast("long")
        root = GO.build_gold(rows.where(key.isNull() | (key % 7 != 3)), scratch_dir(s, "gold-live"), THRESHOLD)
        GO.refresh_gold(s, root, rows.where(key % 7 == 3), rows.where(key % 11 == 5).select("product_id"), THRESHOLD)
        return GO.gold_table(s, root, "rated").select("product_id", "main_category", "bayesian_rating")

    q["refresh_gold"] = refreshed

    def sketched(s, d):
        """Narrow products, and the merged sketches of three batches of them."""
        narrow = staged(_clean(s, d).select("product_id", "main_category", "rating_count"), "narrow")
        batch = F.pmod(F.xxhash64("product_id"), F.lit(3))
        return narrow, SK.merge_sketches(*(staged(SK.category_sketches(narrow.where(batch == b)), "sketches") for b in range(3)))

    def sketch_quantiles(s, d):
        narrow, merged = sketched(s, d)
        qs = {"q20": 0.2, "q25": 0.25, "q50": 0.5, "q80": 0.8}
        at = SK.sketch_quantiles(merged, list(qs.values()), list(qs)).drop("n")
        values = lookup_join(value_counts(narrow, ["main_category"], "rating_count"), at, "main_category")
        total, off = F.sum("n"), 2 * SK.rank_error()
        below = lambda c: F.sum(F.when(F.col("rating_count") < F.col(c), F.col("n")).otherwise(0)) / total
        upto = lambda c: F.sum(F.when(F.col("rating_count") <= F.col(c), F.col("n")).otherwise(0)) / total
        within = [((below(c) - off <= x) & (upto(c) + off >= x)).alias(f"{c}_within") for c, x in qs.items()]
        return values.groupBy("main_category").agg(total.alias("product_count"), *within)

    def sketch_distinct(s, d):
        narrow, merged = sketched(s, d)
        near = lambda c, n: F.abs(F.col(c) - F.col(n)) <= F.greatest(F.lit(1), F.lit(SK.distinct_error()) * F.col(n))
        exact = narrow.groupBy("main_category").agg(F.count_distinct("product_id").alias("distinct_products"))
        per = lookup_join(exact, SK.distinct_per_category(merged), "main_category")
        every = narrow.agg(F.lit("all").alias("main_category"), F.count_distinct("product_id").alias("distinct_products"))
        per = per.unionByName(every.join(F.broadcast(SK.distinct_products(merged))))
        return per.select("main_category", "distinct_products", near("products", "distinct_products").alias("near"))

    q["sketch_quantiles"] = sketch_quantiles
    q["sketch_distinct"] = sketch_distinct

    def keyed(s, d):
        columns = ["product_id", "main_category", "rating", "rating_count"]
        return K.write_keyed(_clean(s, d).select(*columns), scratch_dir(s, "keyed"))

    def product_lookup(s, d):
        # asked for: the products whose number ends with 77, from the parts
        parts = s.read.parquet(f"{d}/part.parquet").where("p_partkey % 100 = 77")
        return K.lookup_products(s, keyed(s, d), parts.select(F.col("p_partkey").cast("string").alias("product_id")))

    q["product_lookup"] = product_lookup
    q["category_lookup"] = lambda s, d: K.lookup_category(s, keyed(s, d), C.OTHER)

    def metrics_roundtrip(s, d):
        m = M.evaluate(M.baseline_predictions(PL.target_split(s, d))).select(
            F.lit("Category Mean Baseline").alias("model"), "rmse", "mae", "r2"
        )
        path = IO.write_metrics_json(m, scratch_dir(s, "metrics_json"))
        return IO.read_metrics(s, path)

    q["read_metrics"] = metrics_roundtrip

    def model_roundtrip(s, d):
        mi = PL.model_inputs(s, d)
        model = M.fit_model("Linear Regression", mi.split.where("split = 'train'"), mi.numeric)
        path = M.save_model(model, scratch_dir(s, "linear_model"), mi.split)
        test = M.load_split(s, path).where("split = 'test'")
        cols = lambda m, name: m.transform(test).select("product_id", F.col("prediction").alias(name))
        both = cols(model, "now").join(cols(M.load_model(path), "loaded"), "product_id")
        return both.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("now") == F.col("loaded")).alias("same_rows"))

    q["save_model"] = model_roundtrip
    return q


RANK_SELECT = """
SELECT product_id, product_name, main_category, rating, rating_count, m_value,
       category_mean_rating, is_suspicious, bayesian_rating, rating_gap,
       rating_rank, bayesian_rank, bayesian_rank - rating_rank AS rank_change, target_rule
FROM ranked ORDER BY abs(bayesian_rank - rating_rank) DESC, product_id LIMIT 50"""


def build_oracle() -> dict[str, str]:
    c15 = O.clean_ctes(THRESHOLD)
    c80 = O.clean_ctes(THRESHOLD_COARSE)
    o: dict[str, str] = {}
    o["products_raw"] = O.with_ctes(c15, "SELECT * FROM raw")
    o["clean_products"] = O.with_ctes(c15, "SELECT * FROM clean")
    o["clean_products_t80"] = O.with_ctes(c80, "SELECT * FROM clean")
    params_sel = "SELECT main_category, m_value, category_mean_rating, product_count FROM params"
    o["category_params"] = O.with_ctes(c15, params_sel)
    o["category_params_t80"] = O.with_ctes(c80, params_sel)
    o["trust_rating"] = O.with_ctes(c15, "SELECT * FROM trust")
    o["trust_detail"] = O.with_ctes(c15, "SELECT * FROM detail")
    o["rank_movers_top50"] = O.with_ctes(c15, RANK_SELECT)
    o["rank_movers_top50_t80"] = O.with_ctes(c80, RANK_SELECT)

    money = lambda c: O.number_sql(f"replace(replace({c}, '₹', ''), ',', '')")
    o["parse_money"] = O.with_ctes(
        c15,
        f"""SELECT ordinal, actual_price AS actual_price_text, {money("actual_price")} AS actual_price,
       discounted_price AS discounted_price_text, {money("discounted_price")} AS discounted_price
FROM raw""",
    )
    o["parse_percent"] = O.with_ctes(
        c15,
        f"""SELECT ordinal, discount_percentage AS discount_percentage_text,
       {O.number_sql("replace(discount_percentage, '%', '')")} AS discount_percentage FROM raw""",
    )
    o["parse_count"] = O.with_ctes(
        c15,
        f"""SELECT ordinal, rating_count AS rating_count_text,
       {O.number_sql("replace(rating_count, ',', '')")} AS rating_count FROM raw""",
    )
    o["parse_numeric"] = O.with_ctes(
        c15, f"SELECT ordinal, rating AS rating_text, {O.number_sql('rating')} AS rating FROM raw"
    )
    second = "string_split(category, '|')[2]"
    o["category_level"] = O.with_ctes(
        c15, f"SELECT ordinal, category, {O.trim_sql(second)} AS second_category FROM raw"
    )
    o["dedup_first"] = O.with_ctes(c15, "SELECT product_id, ordinal FROM firsts")
    o["bucket_rare"] = O.with_ctes(
        c15,
        """SELECT l.product_id, l.second_category, coalesce(m.major, 'Other') AS main_category
FROM leveled l LEFT JOIN majors m ON l.second_category = m.major""",
    )
    o["review_length"] = O.with_ctes(c15, "SELECT product_id, review_length FROM clean")
    o["category_counts"] = O.with_ctes(
        c15,
        """SELECT main_category, product_count, row_number() OVER (ORDER BY product_count DESC, main_category) AS position
FROM (SELECT main_category, count(*) AS product_count FROM clean GROUP BY main_category)""",
    )
    dm = {**c15, **O.dummy_ctes()}
    o["align_schema"] = O.with_ctes(dm, "SELECT * FROM aligned")
    o["allowed_categories"] = O.with_ctes(dm, "SELECT * FROM allowed")
    o["conform_domain"] = O.with_ctes(dm, "SELECT product_id, main_category FROM conformed")
    o["seed_domain"] = O.with_ctes(dm, "SELECT * FROM seeded")
    o["domain_check"] = O.with_ctes(
        dm,
        """SELECT main_category, in_real, in_other, true AS schema_match,
       (sum(CASE WHEN in_real <> in_other THEN 1 ELSE 0 END) OVER () = 0) AS category_match
FROM (SELECT coalesce(a.main_category, b.main_category) AS main_category,
             a.main_category IS NOT NULL AS in_real, b.main_category IS NOT NULL AS in_other
      FROM (SELECT DISTINCT main_category FROM clean) a
      FULL OUTER JOIN (SELECT DISTINCT main_category FROM seeded) b
      ON a.main_category = b.main_category)""",
    )

    o["m_values"] = O.with_ctes(
        c15,
        """SELECT main_category, m_value, product_count,
       row_number() OVER (ORDER BY product_count DESC, main_category) AS count_position,
       row_number() OVER (ORDER BY m_value, main_category) AS m_position FROM params""",
    )
    ext = """
(SELECT 'highest' AS which, main_category, m_value FROM params ORDER BY m_value DESC, main_category LIMIT 1)
UNION ALL
(SELECT 'lowest' AS which, main_category, m_value FROM params ORDER BY m_value ASC, main_category LIMIT 1)"""
    o["m_extremes"] = O.with_ctes(c15, ext)
    summary = f"""
SELECT count(*) AS total_products,
       count(*) - count(*) FILTER (WHERE is_suspicious) AS reliable_products,
       count(*) FILTER (WHERE is_suspicious) AS suspicious_products,
       round_even(CAST(count(*) FILTER (WHERE is_suspicious) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0, 2)
           AS suspicious_pct,
       round_even({O.exact_mean_sql("rating")}, 4) AS mean_rating,
       round_even({O.exact_mean_sql("bayesian_rating")}, 4) AS mean_bayesian_rating,
       round_even({O.exact_mean_sql("rating_gap")}, 4) AS mean_rating_gap
FROM detail"""
    o["trust_summary"] = O.with_ctes(c15, summary)
    o["trust_summary_t80"] = O.with_ctes(c80, summary)
    o["m_choice_compare"] = O.with_ctes(
        c15,
        """
SELECT c.main_category, count(*) AS product_count, max(md.median_m) AS median_m, max(p.m_value) AS q1_m,
       count(*) FILTER (WHERE c.rating_count < md.median_m) AS suspect_median,
       round_even(CAST(count(*) FILTER (WHERE c.rating_count < md.median_m) AS DOUBLE)
                  / CAST(count(*) AS DOUBLE) * 100.0, 1) AS pct_median,
       count(*) FILTER (WHERE c.rating_count < p.m_value) AS suspect_q1,
       round_even(CAST(count(*) FILTER (WHERE c.rating_count < p.m_value) AS DOUBLE)
                  / CAST(count(*) AS DOUBLE) * 100.0, 1) AS pct_q1
FROM clean c
JOIN params p ON c.main_category = p.main_category
JOIN (SELECT main_category, round_even(quantile_cont(rating_count, 0.5), 9) AS median_m
      FROM clean GROUP BY main_category) md ON c.main_category = md.main_category
GROUP BY c.main_category""",
    )

    gd = {**c15, **O.guide_ctes()}
    o["score_candidates"] = O.with_ctes(
        gd,
        """SELECT candidate_id, category, rating, review_count, m_value, category_mean,
       corrected_rating, decline, level, message FROM scoredm""",
    )
    o["compare_pairs"] = O.with_ctes(
        gd,
        """
SELECT pr.pair_id, pr.a_id, pr.b_id, a.category AS a_category, b.category AS b_category,
       a.rating AS a_rating, b.rating AS b_rating, a.review_count AS a_review_count, b.review_count AS b_review_count,
       a.corrected_rating AS a_corrected_rating, b.corrected_rating AS b_corrected_rating,
       a.decline AS a_decline, b.decline AS b_decline, a.level AS a_level, b.level AS b_level,
       CASE WHEN a.corrected_rating > b.corrected_rating THEN 'A'
            WHEN b.corrected_rating > a.corrected_rating THEN 'B' END AS winner
FROM pairs pr JOIN scored a ON pr.a_id = a.candidate_id JOIN scored b ON pr.b_id = b.candidate_id""",
    )

    o["kpis"] = O.with_ctes(
        c15,
        f"""SELECT count(DISTINCT product_id) AS distinct_products,
       count(DISTINCT main_category) AS distinct_categories,
       round_even({O.exact_mean_sql("rating")}, 4) AS mean_rating,
       round_even({O.exact_mean_sql("rating_count", 2)}, 4) AS mean_review_count
FROM clean""",
    )
    qc = {**c15, **O.quintile_ctes()}
    o["review_quintile"] = O.with_ctes(
        qc, "SELECT product_id, rating_count, review_rank, quintile, review_count_group FROM rq"
    )
    o["quintile_summary"] = O.with_ctes(
        qc,
        f"""SELECT quintile, review_count_group, count(*) AS product_count,
       round_even({O.exact_mean_sql("rating")}, 4) AS rating_mean,
       round_even(stddev_samp(rating), 6) AS rating_std,
       min(rating) AS rating_min, max(rating) AS rating_max,
       round_even(quantile_cont(rating, 0.5), 9) AS rating_median
FROM rq GROUP BY quintile, review_count_group""",
    )
    xc = {**c15, **O.extremes_ctes()}
    o["extremes_compare"] = O.with_ctes(
        xc,
        f"""SELECT extreme_group, max(threshold) AS threshold, count(*) AS product_count,
       round_even(stddev_samp(rating), 6) AS rating_std,
       round_even({O.exact_mean_sql("rating")}, 4) AS rating_mean
FROM xg GROUP BY extreme_group""",
    )
    o["category_profile"] = O.with_ctes(
        c15,
        f"""
SELECT a.*, p.m_value AS q1_m, md.median_m FROM
 (SELECT main_category, count(*) AS product_count,
         round_even({O.exact_mean_sql("rating_count", 2)}, 4) AS mean_review_count,
         round_even({O.exact_mean_sql("rating")}, 4) AS mean_rating
  FROM clean GROUP BY main_category) a
LEFT JOIN params p ON a.main_category = p.main_category
LEFT JOIN (SELECT main_category, round_even(quantile_cont(rating_count, 0.5), 9) AS median_m
           FROM clean GROUP BY main_category) md ON a.main_category = md.main_category""",
    )
    hist = {
        "hx": "SELECT main_category, round_even(log10(rating_count + 1), 9) AS lx FROM clean",
        "hr0": "SELECT main_category, min(lx) AS mn, max(lx) AS mx FROM hx GROUP BY main_category",
        "hr": """SELECT main_category, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                 CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM hr0""",
        "hb0": """SELECT x.main_category, x.lx, r.lo, r.hi, (r.hi - r.lo) / 15.0 AS step,
                  least(CAST(floor((x.lx - r.lo) * (15.0 / (r.hi - r.lo))) AS INTEGER), 14) AS b
                  FROM hx x JOIN hr r ON x.main_category = r.main_category""",
        "hb1": """SELECT *, CASE WHEN lx < (CASE WHEN b >= 15 THEN hi ELSE CAST(b AS DOUBLE) * step + lo END)
                  THEN b - 1 ELSE b END AS b1 FROM hb0""",
        "hb2": """SELECT *, CASE WHEN lx >= (CASE WHEN b1 + 1 >= 15 THEN hi ELSE CAST(b1 + 1 AS DOUBLE) * step + lo END)
                  AND b1 <> 14 THEN b1 + 1 ELSE b1 END AS bin FROM hb1""",
        "hc": "SELECT main_category, bin, count(*) AS n FROM hb2 GROUP BY main_category, bin",
    }
    o["histogram15"] = O.with_ctes(
        {**c15, **hist},
        """
SELECT r.main_category, CAST(g.bin AS INTEGER) AS bin,
       CAST(g.bin AS DOUBLE) * ((r.hi - r.lo) / 15.0) + r.lo AS bin_lo,
       CASE WHEN g.bin = 14 THEN r.hi ELSE CAST(g.bin + 1 AS DOUBLE) * ((r.hi - r.lo) / 15.0) + r.lo END AS bin_hi,
       coalesce(c.n, 0) AS product_count
FROM hr r CROSS JOIN range(0, 15) g(bin)
LEFT JOIN hc c ON c.main_category = r.main_category AND c.bin = g.bin""",
    )
    bq_ctes, bq_final = O.box_sql("rq", ["quintile", "review_count_group"], "rating")
    o["box_stats_quintile"] = O.with_ctes({**qc, **bq_ctes}, bq_final)
    bc_ctes, bc_final = O.box_sql("hx", ["main_category"], "lx")
    o["box_stats_category"] = O.with_ctes(
        {**c15, **hist, **bc_ctes}, bc_final.replace("AS lx", "AS log_review_count")
    )
    be_ctes, be_final = O.box_sql("xg", ["extreme_group"], "rating")
    o["box_stats_extremes"] = O.with_ctes({**xc, **be_ctes}, be_final)
    o["funnel_grid"] = O.with_ctes(
        c15,
        """SELECT main_category, CAST(floor(lx * 4) AS INTEGER) AS log_count_bin,
       CAST(round_even(rating * 10.0, 0) AS INTEGER) AS rating_tenths, count(*) AS product_count
FROM (SELECT main_category, rating, round_even(log10(rating_count + 1), 9) AS lx FROM clean)
GROUP BY 1, 2, 3""",
    )
    o["preview_sample"] = O.with_ctes(
        c15,
        """SELECT product_id, product_name, main_category, rating, rating_count, bayesian_rating
FROM trust ORDER BY md5('42|' || product_id) LIMIT 8""",
    )
    _features_oracle(o, c15)
    o["read_listings"] = o["read_zip"] = o["read_zip_members"] = o["products_raw"]
    o["read_listings_numbered"] = o["read_listings_split"] = O.with_ctes(
        c15, "SELECT * REPLACE (row_number() OVER (ORDER BY ordinal) - 1 AS ordinal) FROM raw"
    )
    o["m_values_approx"] = O.with_ctes(
        c15, "SELECT main_category, product_count, true AS near_first_quartile FROM params"
    )
    o["kpis_approx"] = "SELECT true AS distinct_products_near, true AS distinct_categories_near"
    o["write_table"] = o["trust_rating"]
    o["materialize_gold"] = O.with_ctes(
        c15,
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS table_name, count(*) AS row_count,
       CAST(sum(CAST('0x' || substr(md5({key} || '|' || {value}), 1, 8) AS BIGINT)) AS BIGINT) AS content_sum FROM {source}"""
            for name, source, key, value in (
                ("products_clean", "clean", "product_id", "main_category"),
                ("category_params", "params", "main_category", "CAST(CAST(round_even(m_value * 10, 0) AS BIGINT) AS VARCHAR)"),
                ("products_trust", "trust", "product_id", "CAST(CAST(round_even(bayesian_rating * 10000, 0) AS BIGINT) AS VARCHAR)"),
            )
        ),
    )
    o["sketch_quantiles"] = O.with_ctes(
        c15, "SELECT main_category, product_count, true AS q20_within, true AS q25_within, true AS q50_within, true AS q80_within FROM params"
    )
    o["sketch_distinct"] = O.with_ctes(
        c15,
        """SELECT main_category, count(DISTINCT product_id) AS distinct_products, true AS near FROM clean GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT product_id), true FROM clean""",
    )
    o["product_lookup"] = O.with_ctes(
        c15, "SELECT product_id, main_category, rating, rating_count FROM clean WHERE CAST(product_id AS BIGINT) % 100 = 77"
    )
    o["category_lookup"] = O.with_ctes(c15, "SELECT product_id, main_category, rating, rating_count FROM clean WHERE main_category = 'Other'")
    # a product that goes and comes in again in one refresh stays
    changed = {**c15, "raw": f"SELECT * FROM ({c15['raw']}) WHERE coalesce(CAST(product_id AS BIGINT) % 11 <> 5 OR CAST(product_id AS BIGINT) % 7 = 3, true)"}
    o["refresh_gold"] = O.with_ctes(changed, "SELECT product_id, main_category, bayesian_rating FROM trust")
    o["read_metrics"] = o["evaluate_baseline"].replace(
        "SELECT round_even(sqrt(", "SELECT 'Category Mean Baseline' AS model, round_even(sqrt(", 1
    )
    return o


CANDIDATES = ["discounted_price", "actual_price", "discount_percentage", "rating_count", "review_length"]
SPLIT_CUT = int(0.2 * (1 << 32))


def _features_oracle(o: dict[str, str], c15: dict[str, str]) -> None:
    sk = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, skewness({c}) AS s FROM clean" for c in CANDIDATES
    )
    ft = "\nUNION ALL\n".join(
        f"""SELECT product_id, main_category,
       CASE WHEN (SELECT need_log FROM skd WHERE column_name = '{c}') THEN 'log_{c}' ELSE '{c}' END AS feature,
       CASE WHEN (SELECT need_log FROM skd WHERE column_name = '{c}') THEN round_even(ln(1 + {c}), 9)
            ELSE CAST({c} AS DOUBLE) END AS value
FROM clean"""
        for c in CANDIDATES
    )
    split = f"""CASE WHEN CAST(('0x' || substr(md5('42|' || product_id), 1, 8)) AS BIGINT) < {SPLIT_CUT}
                     THEN 'test' ELSE 'train' END"""
    fc = {
        **c15,
        "sk": sk,
        "skd": "SELECT *, coalesce(abs(s) > 1.0, false) AS need_log FROM sk",
        "ft": ft,
        "ready": """SELECT f.*, d.bayesian_rating FROM ft f JOIN detail d ON f.product_id = d.product_id
                    WHERE f.value IS NOT NULL AND f.main_category IS NOT NULL AND d.bayesian_rating IS NOT NULL""",
        "sp": f"SELECT product_id, main_category, bayesian_rating, {split} AS split FROM detail",
        "tr": "SELECT * FROM sp WHERE split = 'train'",
        "te": "SELECT * FROM sp WHERE split = 'test'",
        "cm": f"SELECT main_category, {O.exact_mean_sql('bayesian_rating')} AS cat_mean FROM tr GROUP BY main_category",
        "om": f"SELECT {O.exact_mean_sql('bayesian_rating')} AS all_mean FROM tr",
        "pr": """SELECT te.bayesian_rating AS y, coalesce(cm.cat_mean, om.all_mean) AS p
                 FROM te LEFT JOIN cm ON te.main_category = cm.main_category CROSS JOIN om""",
    }
    o["skew_report"] = O.with_ctes(
        fc, "SELECT column_name, n, round_even(s, 6) AS skew, need_log FROM skd"
    )
    o["log_features"] = O.with_ctes(
        fc, "SELECT product_id, feature, value FROM ft WHERE starts_with(feature, 'log_')"
    )
    o["missing_report"] = O.with_ctes(
        fc,
        """SELECT feature AS column_name, count(*) FILTER (WHERE value IS NULL) AS null_count FROM ft GROUP BY feature
UNION ALL SELECT 'main_category', count(*) FILTER (WHERE main_category IS NULL) FROM clean""",
    )
    o["feature_table"] = O.with_ctes(fc, "SELECT * FROM ft")
    o["model_ready"] = O.with_ctes(fc, "SELECT product_id, main_category, bayesian_rating, feature, value FROM ready")
    o["join_audit"] = O.with_ctes(
        fc,
        """SELECT (SELECT count(*) FROM clean) AS feature_rows, (SELECT count(*) FROM detail) AS target_rows,
       (SELECT count(*) FROM clean c JOIN detail d ON c.product_id = d.product_id) AS merged_rows,
       (SELECT count(*) FROM clean) - (SELECT count(*) FROM clean c JOIN detail d ON c.product_id = d.product_id)
           AS rows_lost,
       (SELECT count(*) FROM clean c JOIN detail d ON c.product_id = d.product_id WHERE d.bayesian_rating IS NULL)
           AS null_targets""",
    )
    o["split_assign"] = O.with_ctes(fc, f"SELECT product_id, {split} AS split FROM clean")
    o["evaluate_baseline"] = O.with_ctes(
        fc,
        """SELECT round_even(sqrt(sum((y - p) * (y - p)) / count(*)), 4) AS rmse,
       round_even(avg(abs(y - p)), 4) AS mae,
       round_even(1.0 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 4) AS r2 FROM pr""",
    )
    o["best_model"] = O.with_ctes(
        fc,
        """SELECT model, round_even(sqrt(sum((y - p) * (y - p)) / count(*)), 4) AS rmse,
       round_even(avg(abs(y - p)), 4) AS mae,
       round_even(1.0 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 4) AS r2, true AS is_best
FROM (SELECT 'Category Mean' AS model, y, p FROM pr
      UNION ALL SELECT 'Overall Mean', te.bayesian_rating, om.all_mean FROM te CROSS JOIN om)
GROUP BY model ORDER BY rmse, model LIMIT 1""",
    )
    for key, name in (("fit_linear", "Linear Regression"), ("fit_forest", "Random Forest"), ("fit_boosted", "Gradient Boosting")):
        o[key] = O.with_ctes(
            fc, f"SELECT '{name}' AS model, count(*) AS test_rows, count(*) AS predicted_rows, true AS fits_better_than_mean FROM te"
        )
    o["compare_models"] = "SELECT 3::BIGINT AS models, 1::BIGINT AS best, true AS best_has_least_rmse, 9::BIGINT AS metrics"
    o["save_model"] = O.with_ctes(fc, "SELECT count(*) AS test_rows, count(*) AS same_rows FROM te")
    o["shap_sampled"] = o["shap_sampled_forest"] = o["shap_forest"] = o["shap_boosted"] = O.with_ctes(
        fc,
        f"""SELECT (SELECT count(*) FROM sp) AS products,
       {len(CANDIDATES)} + (SELECT count(DISTINCT main_category) FROM tr) AS features, true AS adds_up""",
    )
    idx = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CANDIDATES))
    sc = {
        **fc,
        "slots": """SELECT main_category AS slot, row_number() OVER (ORDER BY main_category) - 1 AS i
                    FROM (SELECT DISTINCT main_category FROM tr)""",
        "names": f"""SELECT v.i, 'num__' || CASE WHEN k.need_log THEN 'log_' || v.c ELSE v.c END AS feature,
                    (v.i + 1) / 8.0::DOUBLE AS beta FROM (VALUES {idx}) v(i, c) JOIN skd k ON k.column_name = v.c""",
        "xs": """SELECT product_id, 'num__' || feature AS feature, value FROM ft
                 UNION ALL
                 SELECT s.product_id, 'cat__main_category_' || slot, CASE WHEN s.main_category = slot THEN 1.0 ELSE 0.0 END::DOUBLE
                 FROM sp s CROSS JOIN slots""",
        "betas": """SELECT i, feature, beta FROM names
                    UNION ALL SELECT 5 + i, 'cat__main_category_' || slot, (i % 7 - 3) / 16.0::DOUBLE FROM slots""",
        "ms": f"SELECT feature, {O.exact_mean_sql('value', 9)} AS m FROM xs JOIN tr USING (product_id) GROUP BY feature",
        "sh": """SELECT product_id, feature, value AS feature_value, (value - m) * beta AS shap_value, i
                 FROM xs JOIN ms USING (feature) JOIN betas USING (feature)""",
        "imp": f"SELECT feature, {O.exact_mean_sql('abs(shap_value)', 9)} AS importance FROM sh GROUP BY feature",
    }
    o["shap_linear"] = o["shap_long"] = O.with_ctes(sc, "SELECT product_id, feature, feature_value, shap_value FROM sh")
    o["shap_importance"] = O.with_ctes(sc, "SELECT * FROM imp")
    for key, k in (("top_features", 7), ("top_features5", 5)):
        o[key] = O.with_ctes(sc, f"SELECT * FROM imp ORDER BY importance DESC, feature LIMIT {k}")
    # as many columns as there are features: the category slots depend on the data
    o["shap_wide"] = O.with_ctes(
        sc,
        "SELECT * FROM (PIVOT cells ON cell USING max(v) GROUP BY product_id)",
        {
            "cells": """SELECT product_id, 'value_' || i AS cell, feature_value AS v FROM sh
                        UNION ALL SELECT product_id, 'shap_' || i, shap_value FROM sh"""
        },
    )
    o["top_contributions"] = O.with_ctes(
        sc,
        """SELECT product_id, feature, feature_value, shap_value,
       CAST(row_number() OVER (PARTITION BY product_id ORDER BY abs(shap_value) DESC, feature) AS INTEGER) AS contribution_rank,
       CASE WHEN shap_value >= 0 THEN 'up' ELSE 'down' END AS direction
FROM sh QUALIFY contribution_rank <= 8""",
    )
    o["shap_dependence"] = O.with_ctes(
        sc,
        f"""SELECT feature, value_bin, count(*) AS n, {O.exact_mean_sql("feature_value", 9)} AS mean_feature_value,
       {O.exact_mean_sql("shap_value", 9)} AS mean_shap_value
FROM (SELECT s.*, CAST(CASE WHEN hi - lo > 0 THEN least(floor((feature_value - lo) / ((hi - lo) / 20.0)), 19) ELSE 0 END AS INTEGER) AS value_bin
      FROM sh s JOIN (SELECT feature, min(feature_value) AS lo, max(feature_value) AS hi FROM sh GROUP BY feature) r USING (feature))
GROUP BY feature, value_bin""",
    )
    o["label_features"] = O.with_ctes(
        sc,
        """SELECT feature, importance, CASE WHEN starts_with(feature, 'cat__') THEN 'category: ' || substr(feature, 20)
       ELSE replace(CASE WHEN starts_with(feature, 'num__log_') THEN substr(feature, 10) ELSE substr(feature, 6) END, '_', ' ') END AS label
FROM imp""",
    )
    o["product_explain"] = O.with_ctes(
        sc,
        """
SELECT t.product_id, t.product_name, t.main_category, t.rating, t.rating_count, t.bayesian_rating,
       u.feature AS top_positive_feature, u.feature_value AS top_positive_value, u.shap_value AS top_positive_shap,
       w.feature AS top_negative_feature, w.feature_value AS top_negative_value, w.shap_value AS top_negative_shap
FROM trust t
JOIN (SELECT * FROM sh QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY shap_value DESC, feature DESC) = 1) u USING (product_id)
JOIN (SELECT * FROM sh QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY shap_value, feature) = 1) w USING (product_id)""",
    )
    o["linear_normal_equations"] = O.with_ctes(
        sc,
        """SELECT feature, true AS holds FROM names UNION ALL SELECT 'cat__main_category_' || slot, true FROM slots
UNION ALL SELECT 'intercept', true""",
    )
    o["feature_names"] = O.with_ctes(
        fc,
        f"""
SELECT CAST(v.i AS INTEGER) AS feature_index,
       'num__' || CASE WHEN k.need_log THEN 'log_' || v.c ELSE v.c END AS feature
FROM (VALUES {idx}) v(i, c) JOIN skd k ON k.column_name = v.c
UNION ALL
SELECT CAST({len(CANDIDATES) - 1} + row_number() OVER (ORDER BY main_category) AS INTEGER),
       'cat__main_category_' || main_category
FROM (SELECT DISTINCT main_category FROM tr)""",
    )
    o["product_labels"] = O.with_ctes(
        c15,
        """SELECT product_id, product_id || ' | ' || product_name AS option_label,
       CASE WHEN length(product_name) > 30 THEN substr(product_name, 1, 30) || '...' ELSE product_name END
           AS short_title FROM clean""",
    )
