"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords: all runs of two to
four bytes within its words and their edges, hashed to 8,192 rows.  A linear
softmax over the average gives the language.  Both are trained together by
stochastic gradient descent in numpy on a bounded sample; a fifth of the
sample is left out of the descent and calibrates a temperature, and the score
below which a prediction is rejected.

Prediction needs no embedding per subword: the average is linear, so a text's
logits are its subword counts times one small matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .holdout import held_out, letters, softmax
from .storage import slices, staged, wide_rows
from .textscan import mix

ROWS = 1 << 13
SIZES = (2, 3, 4)
WIDTH = 16
SAMPLE = 8000  # documents learned from, over all languages
PER_LANGUAGE = 1500
EPOCHS, BATCH, RATE = 12, 32, 1.0
ALLOWED_ERROR = 0.01
SLICE = 1 << 20


def subword_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed subwords, one row of 8,192 per text."""
    data, off = letters(texts)
    n = len(off) - 1
    owner = np.repeat(np.arange(n) * ROWS, np.diff(off))
    # an edge of a text is an edge of a word
    data = np.concatenate([data, np.full(max(SIZES), 32, np.uint8)])
    space = data == 32
    out = np.zeros(n * ROWS, np.int64)
    for size in SIZES:
        m = len(owner) - size + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint64)
        for k in range(size):
            value |= data[k : k + m].astype(np.uint64) << np.uint64(8 * k)
        ok = owner[:m] == owner[size - 1 : size - 1 + m]
        inner = np.zeros(m, bool)
        for k in range(1, size - 1):
            inner |= space[k : k + m]
        ok &= ~inner & ~(space[:m] & space[size - 1 : size - 1 + m])
        value = value[ok] + np.uint64(size << 40)
        row = (mix(value) & np.uint64(ROWS - 1)).astype(np.int64)
        out += np.bincount(owner[:m][ok] + row, minlength=n * ROWS)
    return out.reshape(n, ROWS)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # 8,192 x labels: embeddings times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        return (counts.astype(np.float32) / total.astype(np.float32)) @ self.weights + self.bias

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return softmax(self.logits(counts).astype(np.float64) / self.temperature)


def _descend(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, k), np.float32), np.zeros(k, np.float32)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    steps = max(1, EPOCHS * -(-len(y) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            pick = order[a : a + BATCH]
            dense = np.zeros((len(pick), ROWS), np.float32)
            for i, j in enumerate(pick):
                at, share = x[j]
                dense[i, at] = share
            rate = RATE * (1 - step / steps)
            hidden = dense @ table
            slope = softmax(hidden @ weights + bias)
            slope[np.arange(len(pick)), y[pick]] -= 1
            slope /= len(pick)
            back = slope @ weights.T
            weights -= rate * 10 * (hidden.T @ slope)
            bias -= rate * slope.sum(0)
            table -= rate * 100 * (dense.T @ back)
            step += 1
    return table @ weights, bias


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """Train on (language, subword rows, counts); every fifth one calibrates."""
    labels = sorted({lang for lang, _, _ in rows})
    y = np.array([labels.index(lang) for lang, _, _ in rows])
    x = [(at, n.astype(np.float32) / max(1, n.sum())) for _, at, n in rows]
    later = np.arange(len(rows)) % 5 == 4 if len(rows) >= 25 else np.zeros(len(rows), bool)
    weights, bias = _descend([v for v, o in zip(x, later) if not o], y[~later], len(labels), seed)
    model = Model(labels, weights, bias)
    if later.any():
        counts = np.zeros((int(later.sum()), ROWS))
        for i, j in enumerate(np.flatnonzero(later)):
            counts[i, rows[j][1]] = rows[j][2]
        truth, raw = y[later], model.logits(counts).astype(np.float64)

        def loss(t: float) -> float:
            return -np.log(softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean()

        model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
        p = softmax(raw / model.temperature)
        best, right = p.max(1), p.argmax(1) == truth
        order = np.argsort(-best)
        wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(wrong <= ALLOWED_ERROR)
        # the lowest score down to which accepted predictions err as allowed
        model.reject_below = float(best[order[good[-1]]]) if len(good) and good[-1] + 1 < len(order) else 0.0
        if not len(good):
            model.reject_below = 1.0
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", SLICE):
        counts = subword_counts(b.column("text"))
        rows = [np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id"),
                b.column("lang"),
                pa.array([r.astype("<u2").tobytes() for r in rows], pa.binary()),
                pa.array([c[r].astype("<u4").tobytes() for c, r in zip(counts, rows)], pa.binary()),
            ],
            names=["doc_id", "lang", "rows", "counts"],
        )


def train(docs: DataFrame, sample: int = SAMPLE, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on about ``sample`` documents at most, evenly over the languages.

    Only rows outside the held-out fifth, with a language and a letter, count;
    the sample is those with the least hash of their id.  None if there are none.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    each = min(per_language, max(1, sample // len(sizes)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    some = usable.where(draw < share[F.col("lang")]).select("doc_id", "lang", "text")
    found = staged(some.mapInArrow(_features, "doc_id long, lang string, rows binary, counts binary"), "langid-sample")
    rows = found.orderBy("doc_id", "rows").collect()
    return fit([(r.lang, np.frombuffer(r.rows, "<u2").astype(np.int64), np.frombuffer(r.counts, "<u4")) for r in rows])


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            known = b.column("has_letter").to_numpy(zero_copy_only=False)
            p = model.scores(subword_counts(b.column("text")))
            best = p.argmax(1)
            score = np.where(known, p[np.arange(len(best)), best], 0.0)
            lang = np.where(known, np.array(model.labels, object)[best], "und")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(known & (score >= model.reject_below))],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return run


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row of ``docs``.

    ``lang_pred`` is the likeliest learned language, or ``und`` with score 0
    for a null text or one without a letter, and everywhere if no row can be
    learned from; ``accepted`` is false where the score is below the
    calibrated bar.  Rows with a null doc_id are predicted, never learned
    from; repeated rows are predicted alike.  Columns doc_id, text and (to
    learn from) lang are read, others not.
    """
    rows = wide_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(rows)
    rows = rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
