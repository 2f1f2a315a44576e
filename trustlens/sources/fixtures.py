"""Raw product listings derived from the driver's TPC-H-style tables.

The reference reads a product catalogue with decorated strings (currency,
thousands commas, percent signs), duplicate ids, broken ratings and missing
counts.  We derive an equivalent raw table from ``part`` + ``lineitem`` +
``documents`` so that every cleaning rule is exercised and the work grows
with the input tables.  Integer arithmetic keeps every derived value exact,
so Spark and DuckDB produce byte-identical strings (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = [
    "ordinal",
    "product_id",
    "product_name",
    "category",
    "actual_price",
    "discounted_price",
    "discount_percentage",
    "rating",
    "rating_count",
    "review_content",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(cents: F.Column) -> F.Column:
    # decimal keeps the 2-dp value exact before formatting with thousands commas
    return F.concat(F.lit("₹"), F.format_number((cents.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)"), 2))


def products_raw(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """One raw listing per part, plus a second listing for every tenth part.

    Without ``text`` the review is left where it is read and ``review_length``,
    its number of characters (0 without a review), stands in its place: the
    joins then move a number instead of the text.

    Work: one partial aggregate of ``lineitem`` by part key, then two
    equi-joins on the same key (part, documents), which share one hash
    partitioning at scale.
    """
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"
    )
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_quantity", "l_discount")
        .groupBy("l_partkey")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("qty"),
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("disc"),
        )
    )
    docs = read_table(spark, sf_dir, "documents")
    if text:
        docs = docs.select("doc_id", F.col("text").alias("review_content"))
        review = F.col("review_content")
    else:
        docs = docs.select("doc_id", F.length("text").cast("long").alias("review_length"))
        review = F.coalesce("review_length", F.lit(0).cast("long")).alias("review_length")
    pk = F.col("p_partkey")
    base = (
        part.join(lines, pk == F.col("l_partkey"), "left")
        .join(docs, F.expr("p_partkey div 2") == F.col("doc_id"), "left")
        .withColumn(
            "dup",
            F.explode(
                F.when(pk % 10 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ),
        )
    )
    base = base.withColumn("cents", F.round(F.col("p_retailprice") * 100).cast("long") + F.lit(100) * F.col("dup"))
    base = base.withColumn("pct", F.expr("disc div n_lines"))
    base = base.withColumn("tenths", F.lit(10) + (F.col("qty") * 7 + pk * 13) % 41)
    # integer divisions (SQL ``div``) keep every derived number exact
    cents = F.col("cents")
    pct = F.col("pct")
    plain_rating = F.expr("concat(cast(tenths div 10 as string), '.', cast(tenths % 10 as string))")
    rating_text = (
        F.when(pk % 97 == 3, F.lit("|"))
        .when(pk % 193 == 11, F.lit("7.5"))
        # what Java reads as a number and pandas does not
        .when(pk % 83 == 17, F.concat(plain_rating, F.lit("d")))
        .when(pk % 127 == 19, F.lit("0x1p1"))
        .when(pk % 59 == 7, F.concat(F.lit("\t"), plain_rating, F.lit(" ")))
        .otherwise(plain_rating)
    )
    count_value = F.expr("(qty * qty * qty) div 10000")
    # a tab before and a no-break space after the brand
    brand = F.when(pk % 61 == 7, F.concat(F.lit("\t"), F.col("p_brand"), F.lit("\u00a0"))).otherwise(F.col("p_brand"))
    category = (
        F.when(pk % 211 == 5, F.lit(None).cast("string"))
        .when(pk % 101 == 7, F.col("p_type"))
        .otherwise(F.concat_ws("|", F.col("p_type"), brand, F.col("p_name")))
    )
    return base.select(
        (pk * 2 + F.col("dup")).alias("ordinal"),
        pk.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        category.alias("category"),
        _money_text(cents).alias("actual_price"),
        _money_text(F.expr("(cents * (100 - pct)) div 100")).alias("discounted_price"),
        F.concat(pct.cast("string"), F.lit("%")).alias("discount_percentage"),
        rating_text.alias("rating"),
        F.when(pk % 89 == 4, F.lit(None).cast("string"))
        .when(pk % 71 == 9, F.concat(F.format_number(count_value, 0), F.lit("f")))
        .otherwise(F.format_number(count_value, 0))
        .alias("rating_count"),
        review,
    )


_STAGED: dict[tuple, str] = {}
INPUTS = ("part", "lineitem", "documents")


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """A fingerprint of the input files (path, length, change time): a changed
    input has another one.  Lists files, reads none."""
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in INPUTS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{row.n}:{row.h}"


def staged_products_raw(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """``products_raw`` written once per session and input version to the
    shared scratch folder and read back as parquet, the way the reference
    reads its raw listing file: downstream queries scan a file instead of
    deriving it again.  Without ``text`` it is a table of its own."""
    from ..plans.session import scratch_dir

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), input_version(spark, sf_dir), text)
    if key not in _STAGED:
        path = scratch_dir(spark, "products_raw")
        products_raw(spark, sf_dir, text).write.mode("overwrite").parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def products_dummy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second catalogue, a listing per part, with only three columns and messy
    category labels."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    pk = F.col("p_partkey")
    slot = F.expr("p_partkey % 8")
    label = (
        F.when(slot == 0, F.lit("Others"))
        .when(slot == 1, F.lit("others"))
        .when(slot == 2, F.lit("other"))
        .when(slot == 3, F.lit("Unknown"))
        .otherwise(F.col("p_brand"))
    )
    return part.select(
        pk.alias("ordinal"),
        pk.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        label.alias("main_category"),
    )


def candidates(clean: DataFrame) -> DataFrame:
    """Every clean product as a purchase-guide input, with its own count."""
    return clean.select(
        F.expr("ordinal div 2").cast("long").alias("candidate_id"),
        F.col("main_category").alias("category"),
        F.col("rating"),
        F.col("rating_count").cast("long").alias("review_count"),
    )


def pairs(cands: DataFrame) -> DataFrame:
    """Candidate i against candidate i+1 (both must exist)."""
    a = cands.select(F.col("candidate_id").alias("a_id"))
    b = cands.select(F.col("candidate_id").alias("b_id"))
    return a.join(b, F.col("b_id") == F.col("a_id") + 1, "inner").select(
        F.col("a_id").alias("pair_id"), "a_id", "b_id"
    )
