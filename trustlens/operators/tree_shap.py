"""Exact Shapley values of tree ensembles against a whole background table.

The value of a coalition S of a row's features is the mean prediction over the
background rows z of the row with its features outside S taken from z.

A leaf is reached by such a mixed row if every feature on its path passes the
tests of that feature there, with the row's value or with z's.  So of a row and
of a background row only one thing matters: its pattern, which of the path's
features pass.  With p the row's pattern and q that of z, the leaf counts if
each feature is in one of them; those only in p must be in S and those only in
q must not, which fixes the Shapley weights by their numbers a and b alone:

    feature only in p:   v (a - 1)! b! / (a + b)!
    feature only in q:  -v a! (b - 1)! / (a + b)!

Two passes follow.  The first counts the patterns of the background rows, per
tree and leaf, in every task, and adds the counts up.  The second finds each
row's pattern and weighs it against all counted ones: rows meet patterns, never
background rows.  Trees go to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import staged
from ..plans.session import scratch_dir
from .explain import _long, feature_arrays, feature_names, shap_linear

#: Nodes of one block of trees; with the patterns of its leaves, some 50 MB.
BLOCK_NODES = 250_000
# Spark ML grows trees of 30 levels at most, so a leaf's pattern has 30 bits.
_PATTERN_BITS = 32
#: Bits that tell all of a unit (a small subtree) about a row.
UNIT_BITS = 12
#: Rows that a task holds while it walks the trees.
ROWS_AT_ONCE = 100_000


def tree_nodes(model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, value): the
    nodes of a fitted forest or of boosted trees.

    ``feature`` is null in leaves; a row goes left if its value is at most
    ``threshold``, or in ``categories`` where that is not null.  ``value`` is
    what a leaf adds to the prediction.
    """
    from pyspark.sql import SparkSession

    stage = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_dir(spark, "trees")
    stage.write().save(path)
    # a forest averages its trees; boosting adds them up with weights
    boosted = hasattr(stage, "getStepSize")
    weights = [float(w) if boosted else float(w) / stage.getNumTrees for w in stage.treeWeights]
    share = spark.createDataFrame(list(enumerate(weights)), "tree int, weight double")
    d = F.col("nodeData")
    inner = d["leftChild"] >= 0
    known = d["split"]["numCategories"] >= 0
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        d["id"].alias("node"),
        F.when(inner, d["split"]["featureIndex"]).alias("feature"),
        F.when(inner & ~known, d["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & known, d["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        d["leftChild"].alias("left"),
        d["rightChild"].alias("right"),
        d["prediction"].alias("prediction"),
    )
    return nodes.join(F.broadcast(share), "tree").withColumn("value", F.col("prediction") * F.col("weight")).drop("prediction", "weight")


@dataclass
class Unit:
    """A subtree of few nodes.  All that it needs to know of a row is a code:
    which of the path's ``features`` pass, then the tests of its own inner
    ``nodes``."""

    root: int
    features: list[int]
    nodes: list[int]

    @property
    def bits(self) -> int:
        return len(self.features) + len(self.nodes)


@dataclass
class Tree:
    """One tree's nodes by number; arrays for those that are simple."""

    number: int
    feature: list[int | None]
    threshold: list[float | None]
    categories: list[np.ndarray | None]
    left: list[int]
    right: list[int]
    value: list[float]

    def passes_left(self, node: int, x: np.ndarray) -> np.ndarray:
        column = x[:, self.feature[node]]
        if self.categories[node] is not None:
            return np.isin(column, self.categories[node])
        return column <= self.threshold[node]

    def _children(self, node: int, features: list[int], pattern: np.ndarray, goes: np.ndarray):
        """(child, path's features, pattern of each row) of both children."""
        feature = self.feature[node]
        for child, ok in ((self.left[node], goes), (self.right[node], ~goes)):
            if feature in features:  # one more test of it to pass
                bit = 1 << features.index(feature)
                yield child, features, pattern & np.where(ok, -1, ~bit).astype(pattern.dtype)
            else:
                yield child, [*features, feature], pattern + np.multiply(ok, 1 << len(features), dtype=pattern.dtype)

    def leaves(self, x: np.ndarray) -> Iterator[tuple[int, float, list[int], np.ndarray]]:
        """(node, value, path's features, pattern of each row) of every leaf.

        Bit i of a pattern: the row passes all tests of the i-th feature."""
        open_nodes = [(0, [], np.zeros(len(x), np.int64))]
        while open_nodes:
            node, features, pattern = open_nodes.pop()
            if self.feature[node] is None:
                yield node, self.value[node], features, pattern
            else:
                open_nodes += self._children(node, features, pattern, self.passes_left(node, x))

    def inner(self, root: int, most: int) -> list[int] | None:
        """The inner nodes of a subtree; None if there are more than ``most``."""
        found, open_nodes = [], [root]
        while open_nodes:
            node = open_nodes.pop()
            if self.feature[node] is not None:
                if len(found) >= most:
                    return None
                found.append(node)
                open_nodes += [self.left[node], self.right[node]]
        return found

    def units(self, x: np.ndarray) -> Iterator[tuple[Unit, np.ndarray]]:
        """Subtrees of UNIT_BITS at most (or one leaf) that make up the tree,
        each with the code of every row."""
        open_nodes = [(0, [], np.zeros(len(x), np.int32))]
        while open_nodes:
            node, features, code = open_nodes.pop()
            nodes = self.inner(node, max(0, UNIT_BITS - len(features)))
            if nodes is None:
                open_nodes += self._children(node, features, code, self.passes_left(node, x))
                continue
            for i, n in enumerate(nodes, len(features)):
                code = code + np.multiply(self.passes_left(n, x), 1 << i, dtype=np.int32)
            yield Unit(node, features, nodes), code

    def unit_leaves(self, unit: Unit, codes: np.ndarray) -> Iterator[tuple[int, float, list[int], np.ndarray]]:
        """leaves() of a unit, for rows of these codes."""
        k = len(unit.features)
        bit_of = {n: i for i, n in enumerate(unit.nodes, k)}
        open_nodes = [(unit.root, unit.features, codes & ((1 << k) - 1))]
        while open_nodes:
            node, features, pattern = open_nodes.pop()
            if node in bit_of:
                open_nodes += self._children(node, features, pattern, (codes >> bit_of[node]) & 1 == 1)
            else:
                yield node, self.value[node], features, pattern

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for _, value, features, pattern in self.leaves(x):
            out[pattern == (1 << len(features)) - 1] = value
        return out


def as_trees(rows) -> list[Tree]:
    """Trees of the rows of tree_nodes()."""
    by_tree: dict[int, dict[int, object]] = {}
    for r in rows:
        by_tree.setdefault(r.tree, {})[r.node] = r
    out = []
    for number, nodes in sorted(by_tree.items()):
        n = max(nodes) + 1
        col = lambda c, nodes=nodes, n=n: [getattr(nodes[i], c) if i in nodes else None for i in range(n)]
        categories = [None if c is None else np.array(c) for c in col("categories")]
        out.append(Tree(number, col("feature"), col("threshold"), categories, col("left"), col("right"), col("value")))
    return out


def vectors(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


# Patterns of so many features are counted and looked up in an array.
_DENSE_BITS = 14


def _distinct(pattern: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct patterns of k bits, how often each stands)."""
    if k > _DENSE_BITS:
        return np.unique(pattern, return_counts=True)
    counts = np.bincount(pattern, minlength=1 << k)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _places(pattern: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct patterns of k bits, the place among them of each)."""
    if k > _DENSE_BITS:
        return np.unique(pattern, return_inverse=True)
    here = np.zeros(1 << k, np.intp)
    here[pattern] = 1
    found = np.flatnonzero(here)
    here[found] = np.arange(len(found))
    return found, here[pattern]


def held(batches: Iterator[pa.RecordBatch], rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches put together to larger ones, which pay for a walk."""
    rows = rows or ROWS_AT_ONCE
    kept, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        kept.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(kept)
            kept, n = [], 0
    if kept:
        yield pa.concat_batches(kept)


_COUNTS = "tree int, places binary, counts binary"


def _count_patterns(trees):
    """Tasks: background rows to the counts of (leaf, pattern) in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in held(batches):
            x = np.asfortranarray(vectors(b.column("x")))
            for tree in trees.value:
                parts = []
                for unit, code in tree.units(x):
                    codes, n = _distinct(code, unit.bits)
                    for node, _, features, pattern in tree.unit_leaves(unit, codes):
                        found_here, at = _places(pattern, len(features))
                        parts.append((found_here.astype(np.int64) + (node << _PATTERN_BITS), np.bincount(at, n).astype(np.int64)))
                counts = found.setdefault(tree.number, [])
                counts.append((np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])))
                if len(counts) > 8:
                    found[tree.number] = [_added(counts)]
        for number, parts in found.items():
            places, counts = _added(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([places.astype("<i8").tobytes()]), pa.array([counts.astype("<i8").tobytes()])],
                names=["tree", "places", "counts"],
            )

    return run


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    places, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return places, np.bincount(at, np.concatenate([n for _, n in parts]), len(places)).astype(np.int64)


def _add_counts(group: pa.Table) -> pa.Table:
    parts = [tuple(np.frombuffer(v.as_buffer(), "<i8") for v in pair) for pair in zip(group.column("places"), group.column("counts"))]
    places, counts = _added(parts)
    return pa.table({"tree": group.column("tree")[:1], "places": pa.array([places.tobytes()]), "counts": pa.array([counts.tobytes()])})


def _weights(most: int = 31) -> tuple[np.ndarray, np.ndarray]:
    """Shapley weights [a, b] of a feature only in p, and of one only in q."""
    f = math.factorial
    only_p, only_q = np.zeros((most, most)), np.zeros((most, most))
    for a in range(most):
        for b in range(most):
            only_p[a, b] = f(a - 1) * f(b) / f(a + b) if a else 0.0
            only_q[a, b] = f(a) * f(b - 1) / f(a + b) if b else 0.0
    return only_p, only_q


_ONLY_P, _ONLY_Q = _weights()


def leaf_values(p: np.ndarray, q: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """For each pattern ``p`` of ``k`` features the share of a leaf of value 1
    that each feature has, over background patterns ``q`` met ``n`` times."""
    bit = np.arange(k)
    in_q = (q[:, None] >> bit) & 1 == 1
    a, outside = k - in_q.sum(1), (~in_q).astype(float)
    out = np.empty((len(p), k))
    step = max(1, _CELLS // max(1, len(q)))
    for start in range(0, len(p), step):
        some = p[start : start + step]
        in_p = (some[:, None] >> bit) & 1 == 1
        b = k - in_p.sum(1)
        joint = ((some[:, None] | q[None, :]) == (1 << k) - 1) * n
        plus = (joint * _ONLY_P[a[None, :], b[:, None]]) @ outside
        minus = (joint * _ONLY_Q[a[None, :], b[:, None]]).sum(1)
        out[start : start + step] = np.where(in_p, plus, -minus[:, None])
    return out / n.sum()


# Pairs of a row's and a background row's pattern that are weighed at once.
_CELLS = 1 << 20


def _unit_shares(tree: Tree, unit: Unit, codes: np.ndarray, leaf: np.ndarray, pattern_of: np.ndarray, counts: np.ndarray):
    """(features, their shares of the unit's value [feature, code]) for rows of
    these codes."""
    features = sorted({*unit.features, *(tree.feature[n] for n in unit.nodes)})
    place = {f: i for i, f in enumerate(features)}
    table = np.zeros((len(features), len(codes)))
    for node, value, path, pattern in tree.unit_leaves(unit, codes):
        if path:
            s = slice(*np.searchsorted(leaf, [node, node + 1]))
            p, at = _places(pattern, len(path))
            shares = value * leaf_values(p, pattern_of[s], counts[s], len(path))
            table[[place[f] for f in path]] += shares.T[:, at]
    return features, table


def unit_sums(trees: list[Tree], x: np.ndarray, shares, out: np.ndarray) -> None:
    """Add to ``out`` [feature, row] what shares(tree, unit, codes) says of each
    row's code: (features, table [feature, code])."""
    for tree in trees:
        for unit, code in tree.units(x):
            codes, at = _places(code, unit.bits)
            features, table = shares(tree, unit, codes)
            for f, values in zip(features, table):
                if values.any():
                    out[f] += values.take(at)


def _step_table(tree: Tree, unit: Unit, codes: np.ndarray, z: np.ndarray, weight: np.ndarray, perms: list[list[int]], k: int):
    """(perm * k + feature, steps of the unit's value [.., code]) for rows of
    these codes along permutations, against background rows of codes ``z``."""
    bits_of: dict[int, int] = {}
    for i, f in enumerate([*unit.features, *(tree.feature[n] for n in unit.nodes)]):
        bits_of[f] = bits_of.get(f, 0) | 1 << i

    def values(at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at))
        for _, value, path, pattern in tree.unit_leaves(unit, at):
            out[pattern == (1 << len(path)) - 1] = value
        return out

    dense = values(np.arange(1 << unit.bits)) if unit.bits <= _DENSE_BITS else None
    value_of = values if dense is None else dense.take
    met, at = np.unique(z, return_inverse=True)
    shares = np.bincount(at, weight)
    features = list(bits_of)
    table = np.zeros((len(perms), len(features), len(codes)))
    for p, perm in enumerate(perms):
        order = sorted(range(len(features)), key=lambda i, place={f: i for i, f in enumerate(perm)}: place[features[i]])
        for one, w in zip(met.tolist(), shares.tolist()):
            taken = 0
            before = value_of(np.array([one]))[0]
            for i in order:
                taken |= bits_of[features[i]]
                now = value_of((codes & taken) | (one & ~taken))
                table[p, i] += w * (now - before)
                before = now
    return [p * k + f for p in range(len(perms)) for f in features], table.reshape(-1, len(codes))


def tree_steps(trees: list[Tree], x: np.ndarray, z: np.ndarray, weight: np.ndarray, perms: list[list[int]]) -> np.ndarray:
    """Sums [perm * k + feature, row] of the steps that trees' predictions take
    from each background row of ``z`` to each row of ``x`` along permutations.

    A hybrid's code has the row's bits for the features taken and the
    background's for the others, so steps are looked up by the row's code."""
    k = x.shape[1]
    codes_of_z = {(t.number, unit.root): code for t in trees for unit, code in t.units(z)}
    out = np.zeros((len(perms) * k, len(x)))
    shares = lambda tree, unit, codes: _step_table(tree, unit, codes, codes_of_z[tree.number, unit.root], weight, perms, k)
    unit_sums(trees, np.asfortranarray(x), shares, out)
    return out


def _explain(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, counted = block.value
        split = {}
        for number, (places, counts) in counted.items():
            split[number] = places >> _PATTERN_BITS, places & ((1 << _PATTERN_BITS) - 1), counts
        for b in held(batches):
            x = np.asfortranarray(vectors(b.column("x")))
            phi = np.array(vectors(b.column("shap")).T, order="C") if "shap" in b.schema.names else np.zeros(x.shape[::-1])
            unit_sums(trees, x, lambda tree, unit, codes: _unit_shares(tree, unit, codes, *split[tree.number]), phi)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, phi.size + 1, len(phi)), pa.int32()), pa.array(phi.T.ravel()))
            whole = pa.RecordBatch.from_arrays([b.column("product_id"), b.column("x"), flat], names=["product_id", "x", "shap"])
            for start in range(0, len(x), 10_000):
                yield whole.slice(start, 10_000)

    return run


def _blocks(nodes: DataFrame, block_nodes: int) -> list[tuple[int, int]]:
    """Ranges of tree numbers with so many nodes each (one tree at least)."""
    out: list[tuple[int, int]] = []
    held = 0
    # one row per tree of the model
    for r in nodes.groupBy("tree").count().orderBy("tree").collect():
        if out and held + r["count"] <= block_nodes:
            out[-1] = (out[-1][0], r.tree)
            held += r["count"]
        else:
            out.append((r.tree, r.tree))
            held = r["count"]
    return out


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` written in parts that are worth walking all trees for: one per
    core that runs at once, with a thousand rows at least and what a task holds
    at once at most."""
    rows = staged(rows, "vectors")
    n = rows.count()
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, max(1, n // 1_000))
    return rows.repartition(max(parts, -(-n // ROWS_AT_ONCE)))


def tree_attributions(arr: DataFrame, background: DataFrame, nodes: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(product_id, x, shap): exact Shapley values of an ensemble for every row
    of ``arr`` (product_id, x) against every row of ``background`` (x).

    ``nodes`` are rows of tree_nodes().  The values of a row add up to its
    prediction less the mean prediction of the background.  An empty
    background raises.
    """
    spark = arr.sparkSession
    nodes = staged(nodes, "tree-nodes")
    background = dealt(background.select("x"))
    if not background.limit(1).count():
        raise ValueError("empty background")
    arr = dealt(arr.select("product_id", "x"))
    blocks = _blocks(nodes, block_nodes)
    for first, last in blocks:
        trees = as_trees(nodes.where(F.col("tree").between(first, last)).collect())
        sent = spark.sparkContext.broadcast(trees)
        counted = background.mapInArrow(_count_patterns(sent), _COUNTS).groupBy("tree").applyInArrow(_add_counts, _COUNTS)
        # per leaf at most as many patterns as its path's features make
        by_tree = {r.tree: (np.frombuffer(r.places, "<i8"), np.frombuffer(r.counts, "<i8")) for r in counted.collect()}
        block = spark.sparkContext.broadcast((trees, by_tree))
        arr = arr.mapInArrow(_explain(block), "product_id string, x array<double>, shap array<double>")
        if last != blocks[-1][1]:  # the next block adds to what this one found
            arr = staged(arr, "block-sums")
    return arr


def shap_trees(model: PipelineModel, data: DataFrame, train: DataFrame, numeric: list[str], block_nodes: int = BLOCK_NODES, keep=None) -> DataFrame:
    """(product_id, feature, feature_value, shap_value): exact attributions of
    a forest or of boosted trees against the whole training set."""
    rows, background = feature_arrays(model, data), feature_arrays(model, train)
    found = tree_attributions(rows, background, tree_nodes(model), block_nodes)
    return _long(found, feature_names(model, numeric), "shap", keep)


def shap_exact(model: PipelineModel, data: DataFrame, train: DataFrame, numeric: list[str], keep=None) -> DataFrame:
    """Exact attributions of any of the library's models: the closed form of a
    linear model, else shap_trees().  ``keep`` leaves of a row's attributions
    those that are needed (``explain.extremes``, ``explain.largest``)."""
    if hasattr(model.stages[-1], "coefficients"):
        return shap_linear(model, data, train, numeric, keep)
    return shap_trees(model, data, train, numeric, keep=keep)
