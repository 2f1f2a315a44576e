"""End-to-end compositions of the operators (the reference's batch run)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..functions.staging import staged
from ..operators import clean as C
from ..operators import features as FE
from ..operators import trust as T
from ..sources import fixtures as FX


def target_split(spark: SparkSession, sf_dir: str, threshold: int = C.DEFAULT_MIN_PRODUCTS) -> DataFrame:
    """Products with category, target and split; what needs no feature."""
    return FE.split_assign(T.trust_rating(narrow_clean(spark, sf_dir, threshold)))


@dataclass
class ModelInputs:
    clean: DataFrame
    trust: DataFrame
    features: DataFrame
    ready: DataFrame
    numeric: list[str]

    @cached_property
    def split(self) -> DataFrame:
        """``ready`` with its split, written once: models are fitted, kept,
        measured and explained from it."""
        return staged(FE.split_assign(self.ready), "split")


def clean_table(spark: SparkSession, sf_dir: str, threshold: int = C.DEFAULT_MIN_PRODUCTS) -> DataFrame:
    return C.clean_products(FX.staged_products_raw(spark, sf_dir), threshold)


def narrow_clean(spark: SparkSession, sf_dir: str, threshold: int = C.DEFAULT_MIN_PRODUCTS) -> DataFrame:
    """The clean table without the review text, written once: for what reads it
    several times (parameters first, then the rows they belong to).  The text is
    measured where it is read and moved nowhere, and listings are parsed once."""
    raw = FX.staged_products_raw(spark, sf_dir, text=False)
    parsed = staged(C.valid_listings(C.parse_listings(raw)), "narrow-parsed")
    return staged(C.clean_parsed(parsed, threshold), "narrow-clean")


def model_inputs(spark: SparkSession, sf_dir: str, threshold: int = C.DEFAULT_MIN_PRODUCTS) -> ModelInputs:
    """clean -> trust target; clean -> skew-driven features; join; split."""
    clean = narrow_clean(spark, sf_dir, threshold)
    trust = T.trust_rating(clean)
    decisions = FE.log_decisions(clean)
    numeric = FE.feature_columns(decisions)
    feats = FE.feature_table(FE.log_features(clean, decisions), numeric)
    ready = FE.model_ready(feats, trust)
    return ModelInputs(clean, trust, feats, ready, numeric)
