"""Mixing the sources of a corpus to target weights.

Tokens are summed per source, the whole is shared out by weight, and a source
repeats at rate target / size: every document is taken floor(rate) times, and
once more with the remaining fraction as probability, drawn from a hash of
its id.  No source is repeated more often than a limit; what it cannot take
goes to the others by weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from .storage import bounded_broadcast, staged

WEIGHTS = (1, 2, 3)
LIMIT = 3
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words of a text, 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and
    share the sum of all sizes; a target stops at ``limit`` times its source's
    size and the excess is shared again by weight until none is above.  Only
    sums over all sources come to the driver, a few per round of sharing.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = global_row_number(per, [F.col("source").isNull(), F.col("source")], "place")
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = staged(per.select("source", "source_size", pick.cast("long").alias("weight")), "sources")
    most = F.col("source_size") * limit
    total, weight = per.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, share, full = total or 0, weight or 1, F.lit(False)
    while True:
        wide = lambda x: F.lit(x).cast("decimal(38,0)")
        full = F.col("weight") * wide(rest) > most.cast("decimal(19,0)") * wide(share)
        taken, open_ = per.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        now = ((total or 0) - (taken or 0), open_ or 0)
        if now == (rest, share) or not now[1]:
            break
        rest, share = now
    target = F.when(full, most.cast("double")).otherwise(F.lit(float(rest)) * F.col("weight") / F.lit(float(share)))
    return per.select("source", "source_size", target.alias("target"))


def copies_of(doc_id: Column, rate: Column, seed: str = SEED) -> Column:
    """Times that a document is taken at ``rate``: the whole part, and one more
    if 52 bits of a hash of seed and id fall below the fraction."""
    bits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    draw = F.conv(bits, 16, 10).cast("double") / F.lit(float(1 << 52))
    return F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)


def mix_counts(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row.

    ``size`` counts words, ``taken`` is copies * size.  A null text has size
    0, a null source is a source of its own, a null doc_id draws like any
    other id; repeated rows each count and draw alike.  A source of size 0 has
    target 0 and is taken 0 times.  Reads doc_id, source and text only.
    """
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("_source"), size_of(F.col("text")).alias("size"))
    sizes = staged(sizes, "sizes")
    return _counted(sizes, source_targets(sizes.select(F.col("_source").alias("source"), "size"), weights, limit), seed)


def _counted(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    found = rows.join(bounded_broadcast(targets), F.col("_source").eqNullSafe(F.col("source"))).drop("_source", "source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = copies_of(F.col("doc_id"), rate, seed).cast("long")
    return found.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, all columns, each as often as
    mix_counts() takes it (documents without words at their source's rate)."""
    sizes = staged(docs.select("source", size_of(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size")), "source-sizes")
    targets = source_targets(sizes, weights, limit)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("_source"), F.lit(0).alias("size"))
    taken = _counted(rows, targets, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
