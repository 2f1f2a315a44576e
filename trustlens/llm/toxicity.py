"""Toxicity scores from a factorization machine over hashed terms.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

with x_i = 1 for every hashed term of a text.  The pairwise part is what a
linear model has no weight for: two terms that say little alone and much
together.  Terms are words with A-Z folded and all other ASCII bytes taken as
spaces, so case and punctuation hide nothing; a text counts a term once, so
length does not dilute it.

Learned in numpy by adaptive gradient steps on a bounded, documented sample of
labelled rows; which terms take part is decided by the sample's counts of
terms and of pairs of terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .holdout import held_out, letters
from .storage import slices, staged, wide_rows
from .textscan import scan_bytes

BITS = 20
FACTORS = 4
SAMPLE = {1: 4000, 0: 8000}  # rows learned from, at most, by label
MIN_ROWS, MIN_Z, MAX_TERMS = 3, 6.0, 1 << 14
PAIR_CHANCE = 0.01  # of one pair or more passing by chance
EPOCHS, BATCH, RATE, DECAY, KEEP = 40, 64, 0.1, 1e-4, 0.75


def term_sets(texts: pa.Array, column_of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(terms, first): the distinct hashed terms of every text, ascending; with
    ``column_of`` (a column for each bucket, -1 for none) only those it names."""
    data, off = letters(texts)
    w = scan_bytes(data, off)
    term = (w.hashes() >> np.uint64(64 - BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(off) - 1), w.counts)
    if column_of is not None:
        term = column_of[term]
        used = term >= 0
        term, owner = term[used].astype(np.int64), owner[used]
    both = np.unique((owner << BITS) | term)
    return both & ((1 << BITS) - 1), np.searchsorted(both >> BITS, np.arange(len(off)))


@dataclass
class Machine:
    column_of: np.ndarray  # bucket -> column, -1 where a term takes no part
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of texts given as columns."""
        # sums over empty texts are zero
        total = lambda x: np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, 0)])[first]
        w, v = np.diff(total(self.linear[terms])), self.factors[terms]
        pair = np.diff(total(v), axis=0) ** 2 - np.diff(total(v**2), axis=0)
        return self.bias + w + pair.sum(1) / 2

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.margins(*term_sets(texts, self.column_of)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def choose_terms(terms: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets whose share of texts differs clearly between the labels, and
    those of pairs that tell what their terms do not."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    counts = [np.bincount(np.concatenate([np.zeros(0, np.int64), *(t for t, l in zip(terms, y) if l == k)]), minlength=1 << BITS) for k in (0, 1)]
    seen = counts[0] + counts[1]
    p = seen / (n0 + n1)
    z = np.abs(counts[1] / n1 - counts[0] / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
    good = np.flatnonzero((seen >= MIN_ROWS) & (z >= MIN_Z))
    good = good[np.argsort(-z[good], kind="stable")]
    paired = pair_terms(terms, y, counts, seen >= MIN_ROWS)
    return np.sort(np.concatenate([good, paired[~np.isin(paired, good)]])[:MAX_TERMS])


def pair_terms(terms: list[np.ndarray], y: np.ndarray, counts: list[np.ndarray], open_: np.ndarray) -> np.ndarray:
    """Buckets of ``open_`` whose texts together with another one's have a
    label more often than each of the two explains, or both added up; the
    clearest pair first.

    A pair passes if the Chernoff bound of its count, n * KL(share | expected),
    is beyond chance for as many pairs as there are.  Terms too rare for any
    pair of theirs to pass are left out before pairs are counted.
    """
    evidence = np.zeros(1 << BITS)
    share = counts[1] / np.maximum(counts[0] + counts[1], 1)
    base = min(max(y.mean(), 1e-9), 1 - 1e-9)
    bar = np.log(max(1, int(open_.sum())) ** 2 / PAIR_CHANCE)
    logit = lambda p: np.log(np.clip(p, 1e-9, 1) / np.clip(1 - p, 1e-9, 1))
    for label in (1, 0):
        own = share if label else 1 - share
        # rows of the label that a pair needs at least, if all its rows have it
        need = bar / np.maximum(-np.log(np.clip(own, 1e-9, 1)), 1e-9)
        used = np.flatnonzero(open_ & (counts[label] >= need))
        if len(used) < 2:
            continue
        column_of = np.full(1 << BITS, -1, np.int32)
        column_of[used] = np.arange(len(used))
        own, need = own[used], need[used]
        odds = logit(own)
        sides = [_postings([c[c >= 0] for c in (column_of[t] for t, l in zip(terms, y) if l == k)], len(used)) for k in (label, 1 - label)]
        for i in range(len(used)):
            k = _together(*sides[0], i, len(used))
            k[: i + 1] = 0
            j = np.flatnonzero((k >= need) & (k >= need[i]))
            if not len(j):
                continue
            k, n = k[j], k[j] + _together(*sides[1], i, len(used))[j]
            added = sigmoid(odds[i] + odds[j] - logit(base if label else 1 - base))
            q, p = np.clip(np.maximum(np.maximum(own[i], own[j]), added), 1e-9, 1 - 1e-9), k / n
            score = k * np.log(p / q) + (n - k) * np.log(np.clip(1 - p, 1e-9, 1) / (1 - q))
            passed = (p > q) & (score >= bar)
            j, score = used[j[passed]], score[passed]
            if len(j):
                evidence[j] = np.maximum(evidence[j], score)
                evidence[used[i]] = max(evidence[used[i]], score.max())
    found = np.flatnonzero(evidence)
    return found[np.argsort(-evidence[found], kind="stable")]


def _postings(rows: list[np.ndarray], n: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(rows, owner, first): the rows of column c are owner[first[c]:first[c + 1]]."""
    flat = np.concatenate([np.zeros(0, np.int32), *rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    return rows, owner[np.argsort(flat, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=n))])


def _together(rows: list[np.ndarray], owner: np.ndarray, first: np.ndarray, column: int, n: int) -> np.ndarray:
    """How many rows every column shares with ``column``."""
    mine = owner[first[column] : first[column + 1]].tolist()
    return np.bincount(np.concatenate([np.zeros(0, np.int32), *(rows[r] for r in mine)]), minlength=n)


def fit(terms: list[np.ndarray], y: np.ndarray, seed: int = 1) -> Machine:
    """Train on texts given as sets of buckets and 0/1 labels.

    Both labels weigh the same in total, so a score of 0.5 means even odds
    between them however rare one is.
    """
    rng = np.random.default_rng(seed)
    chosen = choose_terms(terms, y)
    column_of = np.full(1 << BITS, -1, np.int16)  # as small as MAX_TERMS lets it be
    column_of[chosen] = np.arange(len(chosen))
    rows = [c[c >= 0].astype(np.int64) for c in (column_of[t] for t in terms)]
    ones = min(max(y.mean(), 0.01), 0.99)
    weight = np.where(y > 0, 0.5 / ones, 0.5 / (1 - ones))
    # without a telling term every text gets the odds of the sample
    bias = 0.0 if len(chosen) else float(np.log(ones / (1 - ones)))
    w, v = np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), FACTORS))
    seen_w, seen_v, seen_b = np.full(len(chosen), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(EPOCHS if len(chosen) else 0):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            pick = order[a : a + BATCH]
            at = np.concatenate([rows[i] for i in pick])
            # a quarter of the terms is left out of a step, so that no term comes
            # to count only in the company of others
            left = rng.random(len(at)) < KEEP
            row = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])[left]
            used, column = np.unique(at[left], return_inverse=True)
            if not len(used):
                continue
            x = np.zeros((len(pick), len(used)))
            x[row, column] = 1
            sums = x @ v[used]
            z = bias + x @ w[used] + (sums**2 - x @ v[used] ** 2).sum(1) / 2
            slope = (sigmoid(z) - y[pick]) * weight[pick] / len(pick)
            g_w = x.T @ slope + DECAY * w[used] / len(pick)
            g_v = x.T @ (slope[:, None] * sums) - v[used] * (x.T @ slope)[:, None] + DECAY * v[used]
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            seen_b += slope.sum() ** 2
            w[used] -= RATE * g_w / np.sqrt(seen_w[used])
            v[used] -= RATE * 0.2 * g_v / np.sqrt(seen_v[used])
            bias -= RATE * slope.sum() / np.sqrt(seen_b)
    return Machine(column_of, bias, w, v)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        terms, first = term_sets(b.column("text"))
        packed = [terms[a:z].astype("<u4").tobytes() for a, z in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "terms"])


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> Machine | None:
    """Fit on at most ``sample[label]`` documents per label: those outside the
    held-out fifth with the least hash of their id.  A doc_id labelled twice
    counts once, as toxic if any of its labels is.  None without any."""
    wide_rows(docs)
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = staged(known.join(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi"), "labelled")
    least = lambda k: known.where(F.col("toxic") == k).orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(sample[k])
    chosen = staged(least(0).unionByName(least(1)), "toxicity-sample")
    # the sample's size is a fixed bound, so it can be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # one row per id, whichever text sorts last
    found = rows.mapInArrow(_terms, "doc_id long, toxic int, terms binary").groupBy("doc_id", "toxic").agg(F.max("terms").alias("terms"))
    got = found.orderBy("doc_id").collect()
    if not got:
        return None
    # copies of one text would make all its words look telling
    kinds: dict[bytes, int] = {}
    for r in got:
        kinds[bytes(r.terms)] = max(r.toxic, kinds.get(bytes(r.terms), 0))
    return fit([np.frombuffer(t, "<u4").astype(np.int64) for t in kinds], np.array(list(kinds.values()), np.float64))


def _score(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield b.drop_columns(["text"]).append_column("score", pa.array(machine.scores(b.column("text"))))

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``score`` is from 0 to 1, ``predicted`` 1 from 0.5 on.  Null and empty
    texts get the score of a text without terms.  Without any label to learn
    from every score is 0.  Rows with a null doc_id are scored, never learned
    from; repeated rows score alike.  Only doc_id and text of ``docs``, doc_id
    and toxic of ``labels`` are read.
    """
    machine = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), "text")
    if machine is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.0).alias("score"))
    else:
        scored = rows.mapInArrow(_score(machine), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that score below 0.5."""
    machine = train(docs, labels)
    if machine is None:
        return docs
    whole = F.struct(*[F.col(c) for c in docs.columns])
    schema = docs.select(whole.alias("_row")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (pa.record_batch([b.column("_row"), b.column("_row").field("text")], ["_row", "text"]) for b in batches)
        for b in slices(texts, "text"):
            yield b.select(["_row"]).filter(pa.array(machine.scores(b.column("text")) < 0.5))

    return docs.select(whole.alias("_row")).mapInArrow(run, schema).select("_row.*")
