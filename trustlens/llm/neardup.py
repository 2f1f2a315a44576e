"""Near-duplicate documents by HyperMinHash signatures.

Every document is its set of distinct five-word shingles.  A signature has
one register for each of 72 buckets: a shingle's hash picks the bucket, and
the smallest value that falls into it is kept as its count of leading zeros
and ten mantissa bits (HyperMinHash; Yu and Weber, 2017), sixteen bits in all.
Empty buckets borrow a register by a fixed probing order, so short texts band
as well as long ones.  24 bands of three registers propose pairs: a pair at
similarity 0.75 agrees in no band with probability 2e-6.  Proposed pairs are
first held against a collision-corrected estimate with a six-sigma margin,
then confirmed on the full shingle sets.

Equal sets collapse into one class first, so copies cost one row each.  In a
bucket of the banding only pairs with the bucket's least member are proposed;
what that leaves open (members of one bucket that are still in different
components) is settled on full sets in blocks, without pair rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import bounded_broadcast, slices, staged, wide_rows
from .textscan import RUN_A, RUN_B, mix, run_hashes, run_starts, scan

SHINGLE = 5
BANDS, ROWS = 24, 3
BUCKETS = BANDS * ROWS
MANTISSA = 10
PROBES = 1024
BLOCK = 256  # members of a bucket whose full sets are compared at once


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): the sorted distinct shingle hashes of every text.

    Words are folded A-Z to a-z.  A text of one to four words is one shingle
    of all its words; one without words has none.
    """
    w = scan(texts, lower=True)
    hashes, counts = w.hashes(), w.counts
    runs = run_hashes(hashes, SHINGLE)
    runs = runs[run_starts(w.first, SHINGLE, len(hashes))]
    n = np.maximum(counts - SHINGLE + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.array(
            [run_hashes(hashes[w.first[i] : w.first[i + 1]], int(counts[i]), RUN_B)[0] for i in short], np.uint64
        ) + counts[short].astype(np.uint64)
        at = np.concatenate([[0], np.cumsum(n)])[short]
        runs = np.insert(runs, at, whole)
        n[short] = 1
    first = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        runs[a:b].sort()
    new = np.ones(len(runs), bool)
    new[1:] = runs[1:] != runs[:-1]
    new[first[:-1][n > 0]] = True
    return runs[new], np.concatenate([[0], np.cumsum(new)])[first]


def _probes() -> np.ndarray:
    # t-th choice of bucket j, the same everywhere
    t = np.arange(PROBES * BUCKETS, dtype=np.uint64) * np.uint64(RUN_A)
    return (mix(t) % np.uint64(BUCKETS)).astype(np.int64).reshape(PROBES, BUCKETS)


def registers(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (documents x 72, 16 bits) of shingle sets."""
    docs = len(first) - 1
    owner = np.repeat(np.arange(docs), np.diff(first))
    scrambled = mix(values ^ np.uint64(RUN_B))
    bucket = ((scrambled >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
    least = np.full(docs * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, owner * BUCKETS + bucket.astype(np.int64), mix(scrambled + np.uint64(RUN_A)))
    empty = (least == np.iinfo(np.uint64).max).reshape(docs, BUCKETS)
    part, exponent = np.frexp(least.astype(np.float64))
    mantissa = ((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out = (((64 - exponent).clip(0, 63) << MANTISSA) | mantissa).astype(np.uint16).reshape(docs, BUCKETS)
    out[empty] = 0
    filled, probes = ~empty, _probes()
    row, col = np.nonzero(empty & filled.any(1)[:, None])
    for choice in probes:
        if not len(row):
            break
        source = choice[col]
        hit = filled[row, source]
        out[row[hit], col[hit]] = out[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    if len(row):
        out[row, col] = out[row, filled[row].argmax(1)]
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        values, first = shingle_sets(b.column("text"))
        n = np.diff(first)
        digests = []
        for salt in (RUN_A, RUN_B):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(salt)))])
            digests.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        sig = registers(values, first)
        flat = pa.Array.from_buffers(pa.binary(2 * BUCKETS), len(n), [None, pa.py_buffer(sig.astype(">u2").tobytes())])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), *map(pa.array, digests), flat.cast(pa.binary())],
            names=["doc_id", "n_shingles", "set_a", "set_b", "registers"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, registers) per document: the size of
    the shingle set, a 128-bit digest of it, and its registers."""
    schema = "doc_id long, n_shingles long, set_a long, set_b long, registers binary"
    return wide_rows(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign, schema)


def _register_matrix(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u2").astype(np.uint16).reshape(-1, BUCKETS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        r = _register_matrix(b.column("registers")).astype(np.int64).reshape(-1, BANDS, ROWS)
        key = (np.arange(BANDS) << 48) + (r[:, :, 0] << 32) + (r[:, :, 1] << 16) + r[:, :, 2]
        node = np.repeat(b.column("node").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(node)], names=["bucket", "node"])


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of two disjoint sets of these sizes agree."""
    levels = np.arange(1, 65, dtype=np.float64)
    low, high = 2.0**-levels, 2.0 ** (1 - levels)

    def at(size):
        load = np.maximum(np.asarray(size, np.float64) / BUCKETS, 1)[:, None]
        return (1 - low) ** load - (1 - high) ** load

    return (at(n) * at(m)).sum(1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of pairs of signatures."""
    raw, chance = (a == b).mean(1), collision_rate(n, m)
    return np.clip((raw - chance) / (1 - chance), 0, 1)


def _promising(threshold: int):
    bar = threshold / 100
    margin = 6 * (bar * (1 - bar) / BUCKETS) ** 0.5

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, m = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            guess = estimate(_register_matrix(b.column("reg_a")), _register_matrix(b.column("reg_b")), n, m)
            # sets of such sizes can reach the threshold at all, and the estimate allows it
            fits = (100 * np.minimum(n, m) >= threshold * np.maximum(n, m)) & (guess >= bar - margin)
            yield b.select(["a", "b"]).filter(pa.array(fits))

    return keep


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        values, first = shingle_sets(b.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists], names=["node", "shingles"])


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the documents whose id is in ``nodes``."""
    wanted = bounded_broadcast(nodes.select(F.col("node").alias("doc_id")))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    return some.mapInArrow(_sets, "node long, shingles array<long>").where(F.size("shingles") > 0)


def _links_within(threshold: int):
    """Spanning links among the members of one block (or two) of a bucket."""

    def links(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        root = group.column("component").to_numpy().copy()
        side = group.column("side").to_numpy()
        sets = [x.values.to_numpy() for x in group.column("shingles")]
        size = np.array([len(x) for x in sets], np.int64)
        _, ids, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = seen[ids] > 1
        member = np.repeat(np.arange(len(sets)), size)[shared]
        column = np.unique(ids[shared], return_inverse=True)[1]
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        member, column = member[order], column[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            block = np.zeros((len(sets), 4096), np.float32)
            block[member[a:b], column[a:b] - low] = 1
            both += block @ block.T
        union = size[:, None] + size[None, :] - both
        near = 100 * both >= threshold * union
        if side.max() != side.min():
            near &= side[:, None] != side[None, :]
        out = []
        for i, j in zip(*np.nonzero(np.triu(near, 1))):
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((node[i], node[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return links


def _unsettled(crowds: DataFrame, component: DataFrame) -> DataFrame:
    """Members (bucket, node, component) of buckets that hold several components.

    Buckets with the same members count once.
    """
    known = crowds.join(component.withColumnRenamed("component", "root"), "node", "left")
    known = known.select("bucket", "node", F.coalesce("root", "node").alias("component"))
    state = known.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum_a"),
        F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("sum_b"),
    )
    open_ = state.where("low <> high").groupBy("members", "sum_a", "sum_b").agg(F.min("bucket").alias("bucket"))
    return known.join(staged(open_.select("bucket", "members"), "open-buckets"), "bucket")


def near_duplicates(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when ``100 * |A and B| >= threshold * |A or B|`` on
    their shingle sets; component_id is the smallest doc_id reachable over
    links, itself included, kept is ``doc_id = component_id``.

    A null or word-less text has the empty set, size 0, and no link.  Rows
    with a null doc_id never name a component: they get their group's, or null
    if alone (kept is then false).  Rows that share a doc_id are one node.
    Only columns doc_id and text are read.  An empty table gives no rows.
    """
    signed = staged(signatures(docs), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    # one class per distinct set, named by its least doc_id (map-side minimum)
    classes = staged(full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "classes")
    reps = signed.join(
        classes.withColumnRenamed("node", "doc_id"), ["set_a", "set_b", "doc_id"], "left_semi"
    ).dropDuplicates(["set_a", "set_b", "doc_id"])
    reps = staged(reps.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "registers"), "representatives")

    bands = reps.select("node", "registers").mapInArrow(_bands, "bucket long, node long")
    buckets = bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last"), F.count(F.lit(1)).alias("members"))
    buckets = staged(buckets.where("leader <> last"), "buckets")
    joined = staged(bands.join(buckets.select("bucket", "leader", "members"), "bucket").where("node <> leader"), "bucket-members")

    pairs = joined.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    side = lambda x: reps.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"reg_{x}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "reg_a", "reg_b")
    likely = staged(likely.mapInArrow(_promising(threshold), "a long, b long"), "likely-pairs")

    # a bucket of two is settled by its one pair; larger ones may leave some open
    crowds = joined.where("members > 2").select("bucket", "node")
    ends = likely.select(F.explode(F.array("a", "b")).alias("node"))
    sets = staged(_sets_of(docs, ends.distinct()), "shingle-sets")
    of = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    links = likely.join(of("a"), "a").join(of("b"), "b").where(
        F.lit(100) * common >= F.lit(threshold) * (F.size("set_a") + F.size("set_b") - common)
    )
    links = staged(links.select("a", "b").unionByName(_same_document(full, classes)), "links")
    component = staged(connected_components(links), "components")

    rest = staged(_unsettled(crowds, component), "unsettled")
    more = _block_links(docs, rest, threshold)
    # contract what is linked already, then join both levels
    root = component.select("node", "component")
    over = more.join(root.select(F.col("node").alias("a"), F.col("component").alias("ra")), "a", "left").join(
        root.select(F.col("node").alias("b"), F.col("component").alias("rb")), "b", "left"
    )
    over = connected_components(over.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    over = over.withColumnRenamed("component", "top")
    nodes = root.select("node", F.col("component").alias("mid")).unionByName(
        over.join(root, "node", "left_anti").select("node", F.col("node").alias("mid"))
    )
    nodes = staged(
        nodes.join(over.withColumnRenamed("node", "mid"), "mid", "left").select("node", F.coalesce("top", "mid").alias("linked")),
        "linked-nodes",
    )
    named = staged(
        classes.join(nodes, "node", "left").select("set_a", "set_b", F.coalesce("linked", "node").alias("group_id")),
        "named-classes",
    )
    out = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    # an empty row goes with the other rows of its doc_id
    empty = staged(signed.where("n_shingles = 0 and doc_id is not null").select("doc_id").distinct(), "empty-ids")
    own = full.join(bounded_broadcast(empty), "doc_id", "left_semi").join(named, ["set_a", "set_b"])
    own = staged(own.groupBy("doc_id").agg(F.min("group_id").alias("own")), "their-groups")
    if own.limit(1).count():
        out = out.join(bounded_broadcast(own), "doc_id", "left").withColumn("group_id", F.when(F.col("n_shingles") > 0, F.col("group_id")).otherwise(F.col("own")))
    component_id = F.coalesce("group_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(False)).alias("kept"),
    )


def _same_document(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one doc_id that has several texts."""
    mark = F.struct("set_a", "set_b")
    ids = full.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select("doc_id")
    ids = staged(ids, "several-texts")
    if not ids.limit(1).count():
        return classes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    of = full.join(bounded_broadcast(ids), "doc_id").join(classes, ["set_a", "set_b"]).select("doc_id", F.col("node").alias("a")).distinct()
    of = staged(of, "their-classes")
    return of.join(of.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").where("a <> b").select("a", "b")


def _block_links(docs: DataFrame, rest: DataFrame, threshold: int) -> DataFrame:
    """Links among the members of unsettled buckets, on their full sets.

    A bucket of m members is cut into ceil(m / 256) blocks; a task holds the
    sets of one pair of blocks, so its memory is bounded whatever the bucket.
    """
    n_blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
    cut = rest.select("bucket", "node", "component", n_blocks.alias("blocks"), mine.alias("mine"))
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.struct(F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    placed = other.select("bucket", task.alias("task"), "node", "component", F.col("mine").alias("side"))
    sets = _sets_of(docs, rest.select("node").distinct())
    filled = placed.join(sets, "node").select("bucket", "task.low", "task.high", "node", "component", "side", "shingles")
    return staged(
        filled.groupBy("bucket", "low", "high").applyInArrow(_links_within(threshold), "a long, b long"), "block-links"
    )


def drop_near_duplicates(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their group.

    Repeated rows of a kept doc_id are copies too: one of them stays.  Rows
    with a null doc_id cannot be told apart and all stay.
    """
    found = near_duplicates(docs, threshold)
    found = staged(found, "near-duplicates")
    columns = docs.columns
    kept = found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_times"))
    kept = staged(kept, "kept-ids")
    out = docs.join(bounded_broadcast(kept.select("doc_id")), "doc_id", "left_semi").select(*columns)
    out = out.unionByName(docs.where("doc_id is null"))
    again = kept.where("_times > 1").select("doc_id")
    if again.limit(1).count():
        one = out.join(again, "doc_id", "left_semi").select(*columns).dropDuplicates(["doc_id"])
        out = out.join(again, "doc_id", "left_anti").select(*columns).unionByName(one)
    return out
