"""Product tables laid out for lookups by category or product id.

Rows stand in order of (category, product id), in row groups of moderate size:
a category's rows are neighbours, and the row groups' own statistics rule out
all others.  Every row group has a Bloom filter of its product ids, so a lookup
of some ids reads the row groups that hold them, wherever those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import lookup_join

ROW_GROUP_BYTES = 8 << 20
# ids of one row group, which its filter is sized for
IDS_PER_GROUP = 100_000
# A filter names so many keys; more are joined, and every row group is read.
NAMED_KEYS = 1_000


def write_keyed(df: DataFrame, path: str, category: str = "main_category", key: str = "product_id", row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Write ``df`` under ``path`` in order of category and key.

    Ranges are cut by both, so a category of a third of all rows is spread over
    many files."""
    placed = df.repartitionByRange(F.col(category), F.col(key)).sortWithinPartitions(category, key)
    placed.write.mode("overwrite").options(
        **{
            "parquet.block.size": row_group_bytes,
            f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.expected.ndv#{key}": IDS_PER_GROUP,
        }
    ).parquet(path)
    return path


def lookup_products(spark: SparkSession, path: str, ids: DataFrame, key: str = "product_id") -> DataFrame:
    """Rows of the table whose key is among ``ids`` (a column ``key``); ids that
    are not there, and nulls, give no row."""
    table = spark.read.parquet(path)
    wanted = ids.select(key).where(F.col(key).isNotNull()).distinct()
    some = [r[0] for r in wanted.limit(NAMED_KEYS + 1).collect()]
    if len(some) > NAMED_KEYS:
        return lookup_join(table, wanted, key, "left_semi")
    # equalities reach the filters of the row groups, an IN of many values does not
    parts = [F.col(key) == k for k in some] or [F.lit(False)]
    while len(parts) > 1:
        parts = [parts[i] | parts[i + 1] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return table.where(parts[0])


def lookup_category(spark: SparkSession, path: str, name: str, category: str = "main_category") -> DataFrame:
    """Rows of one category."""
    return spark.read.parquet(path).where(F.col(category) == name)
