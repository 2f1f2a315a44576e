"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are integers, floor(256 * x) of every component.  A block of
candidates is indexed by dimension: its posting list holds all members in
descending order of the component, cut into segments of equal quantised
impact (the component over 4, rounded down).  For a query a segment's impact
is the most that its postings can add over the least the dimension can add.

Segments of all dimensions are processed in descending impact, in rounds down
to a falling bar.  Each round leaves a member a lower and an upper bound of
its score: dimensions already met count with their segment's limits, the
others add between nothing and the bar.  A member drops out only when its
upper bound is below the k-th best lower bound; once an eighth or less of a
block is left, scoring those exactly is cheaper than another round.

Where the bounds could leave 64 bits, a block is scored exactly instead.

Queries and candidates are laid out as a grid of blocks, each one task's work
in bounded memory, and the best of the blocks are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEP = 4  # width of a segment in components
SAFE = 2.0**62  # bounds of less are held by 64 bits
BLOCK = 1 << 21  # components of candidates indexed together
QUERY_BLOCK = 2048


class ImpactIndex:
    """Posting segments of a block of integer vectors (members x dimensions)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.most = max(float(vectors.max(initial=0)), -float(vectors.min(initial=0)))
        level = np.floor_divide(vectors, STEP)
        order = np.argsort(-level, axis=0, kind="stable")
        self.postings = np.ascontiguousarray(order.T)
        self.levels = np.ascontiguousarray(np.take_along_axis(level, order, 0).T)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(members, exact scores) of every member that can be among the best
        ``k``, ties included."""
        n = len(self.vectors)
        possible = np.arange(n)
        used = np.flatnonzero(query)
        # no sum of _possible() has more than eight times the terms of a score
        heaviest = max(float(query.max(initial=0)), -float(query.min(initial=0)))
        if 8 * (self.most + STEP) * heaviest * len(used) >= SAFE:
            return possible, self._exact(query)
        if n > 4 * k and len(used):
            possible = self._possible(query, used, k, n)
        return possible, self.vectors[possible] @ query

    def _exact(self, query: np.ndarray) -> np.ndarray:
        """Scores of all members by Python's integers; one that 64 bits cannot
        hold is an error."""
        weights = query.tolist()
        return np.array([sum(a * b for a, b in zip(v.tolist(), weights)) for v in self.vectors], object).astype(np.int64)

    def _possible(self, query: np.ndarray, used: np.ndarray, k: int, n: int) -> np.ndarray:
        w = query[used]
        gap = np.abs(w) * (STEP - 1)
        # a segment's impact is |w| * STEP * (levels from the worst one) + gap;
        # the best segments of a dimension stand at the end of its list that
        # the sign of the weight chooses
        top, bottom = self.levels[used, 0], self.levels[used, -1]
        worst = np.where(w > 0, bottom, top)
        most = np.abs(w) * STEP * (top - bottom) + gap
        # per member: the sum of what is sure, and how many dimensions it was
        # met in
        lower, met = np.zeros(n, np.int64), np.zeros(n, np.int64)
        taken = np.zeros(len(used), np.int64)
        bar = int(most.max())
        while True:
            bar = bar * 2 // 3
            for i, d in enumerate(used):
                if most[i] <= bar or taken[i] == n:
                    continue
                # levels whose impact is above the bar
                reach = (bar - int(gap[i])) // (abs(int(w[i])) * STEP)
                levels = self.levels[d]
                if w[i] > 0:
                    upto = int(np.searchsorted(-levels, -(worst[i] + reach), side="left"))
                    part = slice(int(taken[i]), upto)
                else:
                    upto = n - int(np.searchsorted(-levels, -(worst[i] - reach), side="right"))
                    part = slice(n - upto, n - int(taken[i]))
                if upto > taken[i]:
                    members = self.postings[d, part]
                    lower[members] += int(w[i]) * STEP * (levels[part] - worst[i])
                    met[members] += 1
                    taken[i] = upto
            # dimensions not met add no more than the bar
            upper = lower + int(gap.sum() + np.minimum(most, bar).sum()) - bar * met
            kth = np.partition(lower, n - k)[n - k]
            possible = np.flatnonzero(upper >= kth)
            if len(possible) * 8 <= n or (taken == n).all():
                return possible


def _search(k: int):
    names = ["query_id", "vec_id", "score"]

    def stack(column: pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks()
        return column.flatten().to_numpy().reshape(len(column), -1).astype(np.int64)

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if candidates.num_rows and queries.num_rows:
            ids = candidates.column("vec_id").to_numpy()
            index = ImpactIndex(stack(candidates.column("ints")))
            for q, vector in zip(queries.column("vec_id").to_numpy(), stack(queries.column("ints"))):
                # the query's own rows may take places, so search for more
                own = int((ids == q).sum())
                members, scores = index.search(vector, min(k + own, len(ids)))
                other = ids[members] != q
                members, scores = members[other], scores[other]
                best = np.lexsort((ids[members], -scores))[:k]
                out[0] += [int(q)] * len(best)
                out[1] += ids[members[best]].tolist()
                out[2] += scores[best].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in out], names=names)

    return run


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, dims, ints) of the rows that take part: components become
    floor(256 * x); a null id or vector, a null or non-finite component, or an
    empty vector leaves a row out.  A component beyond 64 bits is an error."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    rows = rows.where(F.size("embedding") > 0)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size("embedding").alias("dims"),
        F.transform(x, lambda v: F.when(F.abs(v) >= 2.0**55, F.raise_error(F.lit("component beyond 64 bits")).cast("long")).otherwise(F.floor(v * 256))).alias("ints"),
    )


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best inner products of every
    query (rows whose vec_id is divisible by ``every``) with all other rows.

    Ranks count from 1, equal scores go to the smaller vec_id; with fewer than
    ``k`` candidates all are returned.  Rows that quantised() leaves out are
    neither queries nor candidates.  Rows with a query's own vec_id are no
    candidates of it; other repeated rows each count.  Vectors are compared
    only with vectors of the same length.  Only vec_id and embedding are read.
    """
    rows = quantised(vectors)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id", "ints"])
    sizes = rows.agg(F.sum("dims"), F.sum(F.when(F.pmod("vec_id", F.lit(every)) == 0, 1))).first()
    n_blocks, n_query_blocks = 1 + (sizes[0] or 0) // BLOCK, 1 + (sizes[1] or 0) // QUERY_BLOCK

    def in_grid(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        # repeated rows spread too: the vector and the row's place take part
        spread = F.pmod(F.xxhash64("vec_id", "ints", F.monotonically_increasing_id()), F.lit(n_own)).cast("int")
        return df.withColumn(own, spread).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    grid = ["block", "query_block", "dims"]
    cells = in_grid(rows, "block", n_blocks, "query_block", n_query_blocks).groupBy(*grid)
    asked = in_grid(queries, "query_block", n_query_blocks, "block", n_blocks).groupBy(*grid)
    found = cells.cogroup(asked).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
