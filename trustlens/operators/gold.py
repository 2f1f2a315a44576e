"""Gold tables that follow inserts and removals without being built anew.

Everything the adjusted rating needs of its category - m, the mean rating C and
whether the category is folded into ``Other`` - follows from one small table,
(category, review count, n, sum of ratings).  A refresh counts the inserted and
removed rows in the same way, adds the difference to that table, derives the
parameters again, and writes only what they changed: the rated products of
categories whose m, C or rows are not what they were.

On disk, under one root, every table is written in versions and nothing is ever
overwritten:

    listings/v=N/folder=...            rows inserted by version N, by second_category
    removed/v=N                        (product_id) that version N took out
    values/v=N                         (second_category, rating_count, n, rating_sum)
    params/v=N                         parameters per category
    rated/v=N/folder=...               rated products written by version N, by main_category
    live/v=N                           (main_category, part): versions of ``rated``
                                       that hold a category's rows, and in ``part``
                                       -1 where it has none

``live`` is written last: a version counts once it is there, so a reader sees
one version or the next, and a refresh that was cut off is written over by the
next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.scalar import category_level
from ..functions.staging import staged
from .clean import CLEAN_COLUMNS, DEFAULT_MIN_PRODUCTS, OTHER, dedup_first, parse_listings, valid_listings
from .trust import category_params, gated_rating

_LISTINGS = (
    "product_id string, product_name string, actual_price double, discounted_price double, discount_percentage double, rating double, "
    "rating_count double, review_content string, review_length long, ordinal long, second_category string, v int, folder string"
)
_RATED = (
    "product_id string, product_name string, rating double, rating_count double, bayesian_rating double, is_suspicious boolean, "
    "ordinal long, main_category string, v int, folder string"
)
_NARROW = ["product_id", "ordinal", "second_category", "rating", "rating_count"]
# Categories are few; beyond this many a filter by value is not worth its plan.
PRUNED_CATEGORIES = 1_000


def leveled_listings(raw: DataFrame) -> DataFrame:
    """Raw listings parsed, checked and deduplicated, before rare categories
    are folded."""
    first = dedup_first(valid_listings(parse_listings(raw)))
    text = F.coalesce(F.col("review_content"), F.lit(""))
    leveled = first.withColumn("second_category", category_level("category", 1)).withColumn("review_content", text)
    return leveled.select(*(c for c in CLEAN_COLUMNS if c != "main_category"), "second_category")


def _folder(category: Column) -> Column:
    """A folder's name: no category and an empty one have names of their own."""
    return F.when(category.isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), category))


def _write(df: DataFrame, root: str, table: str, version: int, by: str | None = None) -> None:
    out = df.withColumn("folder", _folder(F.col(by))).write.partitionBy("folder") if by else df.write
    out.mode("overwrite").parquet(f"{root}/{table}/v={version}")


def _versions(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def current_version(spark: SparkSession, root: str) -> int:
    """The last version that was written to its end."""
    return spark.read.parquet(f"{root}/live").agg(F.max("v")).first()[0]


def _counted(rows: DataFrame, sign: int) -> DataFrame:
    rating = F.sum(F.col("rating").cast("decimal(38,4)") * sign).cast("decimal(38,4)")
    counts = rows.where(F.col("rating_count").isNotNull()).groupBy("second_category", "rating_count")
    return counts.agg((F.count(F.lit(1)) * sign).alias("n"), rating.alias("rating_sum"))


def _folds(values: DataFrame, min_products: int) -> DataFrame:
    """(second_category, main_category): rare and unknown ones are ``Other``."""
    sizes = values.groupBy("second_category").agg(F.sum("n").alias("size"))
    major = F.col("second_category").isNotNull() & (F.col("size") >= min_products)
    return staged(sizes.select("second_category", F.when(major, F.col("second_category")).otherwise(OTHER).alias("main_category")), "folds")


def _folded(rows: DataFrame, folds: DataFrame) -> DataFrame:
    """``rows`` with main_category; a null or unknown category is ``Other``."""
    known = lookup_join(rows, folds.where(F.col("second_category").isNotNull()), "second_category")
    return known.withColumn("main_category", F.coalesce("main_category", F.lit(OTHER)))


def _params(values: DataFrame, folds: DataFrame) -> DataFrame:
    folded = _folded(values, folds).groupBy("main_category", "rating_count").agg(F.sum("n").alias("n"), F.sum("rating_sum").alias("rating_sum"))
    return category_params(values, values=staged(folded, "folded-values"))


def _rated(rows: DataFrame, folds: DataFrame, params: DataFrame) -> DataFrame:
    """Products with adjusted rating and suspicion, by main_category."""
    joined = lookup_join(_folded(rows, folds), params.select("main_category", "m_value", "category_mean_rating"), "main_category")
    return joined.select(
        "product_id",
        "product_name",
        "rating",
        "rating_count",
        gated_rating().alias("bayesian_rating"),
        F.coalesce(F.col("rating_count") < F.col("m_value"), F.lit(False)).alias("is_suspicious"),
        "ordinal",
        "main_category",
    )


def build_gold(raw: DataFrame, root: str, min_products: int = DEFAULT_MIN_PRODUCTS) -> str:
    """Version 0 of the gold tables of raw listings, under ``root``."""
    spark = raw.sparkSession
    rows = leveled_listings(raw)
    _write(rows, root, "listings", 0, "second_category")
    rows = _versions(spark, root, "listings", _LISTINGS).where("v = 0")
    _write(spark.createDataFrame([], "product_id string"), root, "removed", 0)
    _write(_counted(rows, 1), root, "values", 0)
    values = spark.read.parquet(f"{root}/values/v=0")
    folds = _folds(values, min_products)
    _write(_params(values, folds), root, "params", 0)
    params = spark.read.parquet(f"{root}/params/v=0")
    _write(_rated(rows, folds, params), root, "rated", 0, "main_category")
    _write(params.select("main_category", F.lit(0).alias("part")), root, "live", 0)
    return root


def _live_listings(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Listings that are in after ``version``: inserted and not removed since."""
    rows = _versions(spark, root, "listings", _LISTINGS).where(F.col("v") <= version)
    removed = _versions(spark, root, "removed", "product_id string, v int").where(F.col("v") <= version)
    last = removed.groupBy("product_id").agg(F.max("v").alias("gone"))
    return rows.join(last, "product_id", "left").where(F.col("gone").isNull() | (F.col("gone") <= F.col("v"))).drop("gone")


def gold_table(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A gold table as of a version, by default the last one: ``listings``,
    ``values``, ``params`` or ``rated``."""
    version = current_version(spark, root) if version is None else version
    if table == "listings":
        return _live_listings(spark, root, version).drop("v", "folder")
    if table != "rated":
        return spark.read.parquet(f"{root}/{table}/v={version}")
    live = spark.read.parquet(f"{root}/live/v={version}").where("part >= 0")
    parts = live.withColumnRenamed("part", "v")
    return lookup_join(_versions(spark, root, "rated", _RATED), parts, ["main_category", "v"], "left_semi").drop("v", "folder")


def _in_categories(rows: DataFrame, column: str, categories: DataFrame) -> DataFrame:
    """``rows`` of some categories, by a column of category or folder; few ones
    prune the folders that are read."""
    folders = categories.select(_folder(F.col(categories.columns[0])).alias("_tl_folder"))
    names = [r[0] for r in folders.limit(PRUNED_CATEGORIES + 1).collect()]
    marked = rows.withColumn("_tl_folder", F.col(column) if column == "folder" else _folder(F.col(column)))
    if len(names) > PRUNED_CATEGORIES:
        return lookup_join(marked, folders, "_tl_folder", "left_semi").drop("_tl_folder")
    return rows.where((F.col(column) if column == "folder" else _folder(F.col(column))).isin(names))


def refresh_gold(
    spark: SparkSession,
    root: str,
    inserted: DataFrame | None = None,
    removed: DataFrame | None = None,
    min_products: int = DEFAULT_MIN_PRODUCTS,
) -> DataFrame:
    """Write the next version: products of ``removed`` (product_id) go, then raw
    listings of ``inserted`` come in.  Returns (main_category, change) of the
    categories whose rated products were ``rewritten``, ``appended`` to, or of
    which none is left (``emptied``).

    The tables are those that build_gold() would make of all raw listings so
    far without the removed products; of listings with one product id the valid
    one with the least ordinal counts.  Removed ids that are not there and
    listings that are not valid change nothing.
    """
    old = current_version(spark, root)
    new = old + 1
    if removed is None:
        removed = spark.createDataFrame([], "product_id string")
    have = _live_listings(spark, root, old).select(*_NARROW)
    removed = staged(removed.select(F.col("product_id").cast("string").alias("product_id")).where("product_id is not null").distinct(), "to-remove")
    if inserted is None:
        fresh = spark.createDataFrame([], _LISTINGS).drop("v", "folder")
    else:
        fresh = leveled_listings(inserted)
    fresh = staged(fresh, "to-insert")
    # of what is there, only the ids that come or go
    ids = fresh.select("product_id", F.col("ordinal").alias("fresh_ordinal")).join(removed.withColumn("asked", F.lit(True)), "product_id", "full")
    touched = staged(have.join(ids, "product_id"), "touched")
    replaced = F.col("asked").isNull() & (F.col("fresh_ordinal") < F.col("ordinal"))
    gone = touched.where(F.col("asked") | replaced).select(*_NARROW)
    kept = touched.where(F.col("asked").isNull() & ~replaced).select("product_id")
    coming = staged(fresh.join(kept, "product_id", "left_anti"), "inserted")
    gone = staged(gone, "removed")

    # the table of values is merged, not counted again
    before = spark.read.parquet(f"{root}/values/v={old}")
    changes = before.unionByName(_counted(coming, 1)).unionByName(_counted(gone, -1))
    merged = changes.groupBy("second_category", "rating_count").agg(F.sum("n").alias("n"), F.sum("rating_sum").cast("decimal(38,4)").alias("rating_sum"))
    _write(merged.where("n > 0"), root, "values", new)
    values = spark.read.parquet(f"{root}/values/v={new}")
    folds, old_folds = _folds(values, min_products), _folds(before, min_products)
    _write(_params(values, folds), root, "params", new)
    params, old_params = (spark.read.parquet(f"{root}/params/v={v}") for v in (new, old))
    _write(gone.select("product_id"), root, "removed", new)
    _write(coming, root, "listings", new, "second_category")

    # what is per category from here on has one row each
    name = F.col("main_category")
    a, b = (p.select("main_category", F.struct("m_value", "category_mean_rating").alias(c)) for p, c in ((old_params, "was"), (params, "is")))
    differ = a.join(b, "main_category", "full").where(~F.col("was").eqNullSafe(F.col("is"))).select("main_category")
    pairs = old_folds.join(folds.withColumnRenamed("main_category", "now"), old_folds.second_category.eqNullSafe(folds.second_category))
    moved = pairs.where(name != F.col("now")).select(F.explode(F.array(name, F.col("now"))).alias("main_category"))
    lost = _folded(gone, old_folds).select("main_category")
    rewrite = staged(differ.union(moved).union(lost).distinct(), "to-rewrite")
    gained = _folded(coming, folds).select("main_category").distinct()
    append = staged(gained.join(rewrite, "main_category", "left_anti"), "to-append")

    whole = _in_categories(_folded(_live_listings(spark, root, new), folds), "main_category", rewrite)
    # of listings, only folders of categories that fold into one of these are read
    sources = folds.join(rewrite, "main_category", "left_semi").select("second_category")
    if not rewrite.where(name == OTHER).limit(1).count():
        whole = _in_categories(whole, "folder", sources)
    more = _in_categories(_folded(coming, folds), "main_category", append)
    columns = ["product_id", "product_name", "rating", "rating_count", "ordinal", "second_category"]
    rows = whole.select(*columns).unionByName(more.select(*columns))
    _write(_rated(rows, folds, params), root, "rated", new, "main_category")

    live = spark.read.parquet(f"{root}/live/v={old}").where("part >= 0")
    now = params.select("main_category")
    stays = live.join(rewrite, "main_category", "left_anti")
    written = rewrite.join(now, "main_category", "left_semi").union(append).select("main_category", F.lit(new).alias("part"))
    empty = rewrite.join(now, "main_category", "left_anti").select("main_category", F.lit(-1).alias("part"))
    _write(stays.unionByName(written).unionByName(empty), root, "live", new)
    gone_now = empty.select("main_category", F.lit("emptied").alias("change"))
    rewritten = rewrite.join(now, "main_category", "left_semi").select("main_category", F.lit("rewritten").alias("change"))
    return rewritten.unionByName(append.select("main_category", F.lit("appended").alias("change"))).unionByName(gone_now)
