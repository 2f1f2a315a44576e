"""Column-level helpers.  All of them build JVM expressions (no Python UDFs),
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results:
# the currency sign and thousands separator stripped from prices, the percent
# sign stripped from discounts, the comma stripped from counts, and the
# separator of the category path.
CURRENCY_CHARS = "₹,"
PERCENT_CHARS = "%"
COUNT_CHARS = ","
CATEGORY_SEPARATOR = "|"
# Every character that Python's ``str.strip`` removes.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# What pandas ``to_numeric`` reads as a number; Java's parser also takes type
# suffixes (4d, 4.5f) and hexadecimal floats, which are text here.
NUMBER_PATTERN = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_numeric(c: str | Column) -> Column:
    """Text -> double; unparsable text -> NULL (never an exception).

    Only plain decimal and exponent forms count, with white space around them
    allowed; the literal text ``nan`` is missing, never NaN (which Spark sorts
    above every number).
    """
    text = F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))
    return F.when(text.rlike(f"^({NUMBER_PATTERN})$"), text.try_cast("double"))


def parse_money(c: str | Column) -> Column:
    """``₹1,099.00`` -> 1099.0"""
    return parse_numeric(F.translate(_col(c).cast("string"), CURRENCY_CHARS, ""))


def parse_percent(c: str | Column) -> Column:
    """``64%`` -> 64.0"""
    return parse_numeric(F.translate(_col(c).cast("string"), PERCENT_CHARS, ""))


def parse_count(c: str | Column) -> Column:
    """``24,269`` -> 24269.0"""
    return parse_numeric(F.translate(_col(c).cast("string"), COUNT_CHARS, ""))


def category_level(c: str | Column, level: int = 1) -> Column:
    """Element ``level`` (0-based) of the ``|`` path, without the white space
    around it (tabs, line ends and no-break spaces too); NULL if absent."""
    parts = F.split(_col(c), "\\" + CATEGORY_SEPARATOR)
    return F.btrim(F.get(parts, F.lit(level)), F.lit(WHITE_SPACE))


def round_even(c: str | Column, digits: int) -> Column:
    """Round half to even on doubles, the way numpy/pandas ``round`` does.

    Spark's ``round`` is half-up and ``bround`` works on the decimal
    expansion; ``rint(x * 10^d) / 10^d`` reproduces numpy bit for bit.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def exact_mean(c: str | Column, scale: int = 4) -> Column:
    """Order-independent mean: exact decimal sum, one double division.

    A double sum depends on the order partitions are merged in, so a mean
    rounded to 4 dp could flip between runs; summing ``decimal(38, scale)``
    is exact and the single division gives the same double in any engine.
    """
    dec = _col(c).cast(f"decimal(38,{scale})")
    return F.try_divide(F.sum(dec).cast("double"), F.count(dec).cast("double"))


def log10p(c: str | Column, digits: int = 9) -> Column:
    """``log10(x + 1)`` rounded to ``digits`` decimals (cross-engine stable)."""
    return round_even(F.log10(_col(c) + F.lit(1.0)), digits)


def log1p_stable(c: str | Column, digits: int = 9) -> Column:
    """``ln(1 + x)`` rounded to ``digits`` decimals (cross-engine stable)."""
    return round_even(F.log1p(_col(c)), digits)


def adjusted_skew(c: str | Column) -> Column:
    """Bias-adjusted sample skewness (pandas ``skew``).

    ``F.skewness`` is the population g1; multiply by sqrt(n(n-1))/(n-2).
    NULL for n < 3.
    """
    x = _col(c)
    n = F.count(x).cast("double")
    factor = F.sqrt(n * (n - F.lit(1.0))) / (n - F.lit(2.0))
    return F.when(n >= 3, F.skewness(x) * factor)


def quintile_of_rank(rank: str | Column, n: str | Column, q: int = 5) -> Column:
    """Bin of ``pd.qcut(rank, q)`` for ranks 1..n, in exact integer arithmetic.

    qcut edges are 1 + k(n-1)/q, bins are right-closed with the lowest edge
    included, so rank r lands in ceil(q(r-1)/(n-1)), at least 1.  This is not
    ``ntile``: n=7 gives sizes 2,1,1,1,2 where ntile gives 2,2,1,1,1.
    """
    r = _col(rank).cast("long")
    total = _col(n).cast("long")
    span = total - F.lit(1)
    num = F.lit(q) * (r - F.lit(1))
    ceil_div = F.when(span > 0, (num + span - F.lit(1)).cast("long") / span)
    return F.greatest(F.lit(1), F.coalesce(F.floor(ceil_div).cast("int"), F.lit(1)))


def hash_unit_interval_bucket(key: str | Column, seed: int | str) -> Column:
    """First 8 hex digits of md5(seed|key) as an integer in [0, 2^32).

    A per-row hash: no shuffle, stable under repartitioning, identical in any
    engine that has md5.
    """
    digest = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def truncate_label(c: str | Column, width: int = 30, suffix: str = "...") -> Column:
    """Cut text longer than ``width`` characters and append ``suffix``."""
    x = _col(c)
    return F.when(F.length(x) > width, F.concat(F.substring(x, 1, width), F.lit(suffix))).otherwise(x)
