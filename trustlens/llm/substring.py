"""Exact removal of word windows that occur more than once in a corpus.

A window is ``width`` consecutive words of one document.  Counting every
window exactly would shuffle a row per word, so a count-min sketch goes first.

Pass one gives every window an anchor: the least hash among its runs of
eight words.  Equal windows have equal anchors at equal places, so the number
of places where an anchor stands is never below the number of places where
one of its windows starts: counts kept by anchor overestimate window counts,
with about an eleventh of the entries.  Each partition turns its anchors into a
sparse count-min sketch of two rows, cut into tiles by hash; the partition
sketches are merged tile by tile, and a tile tells every chunk of documents
which of its own cells hold two or more.  No sketch is ever in one place, so
it can grow with the corpus: some ten thousand anchors meet in a tile of
2 x 65,536 counters.

Pass two reads a chunk of documents next to its answers, and only windows
whose estimate is two or more go on, as 127-bit hashes, to be grouped exactly;
a chunk sends each once, sorted, and gets one bit for each back.  Pass three
finds the same windows in the same order and cuts what the bits mark.  An
estimate is never too low, so none is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import slices, staged, wide_rows
from .textscan import RUN_A, RUN_B, mix, run_hashes, run_starts, scan, sliding

WIDTH = 35
ANCHOR = 8
CHUNK_BYTES = 8 << 20  # text in one chunk of documents
SHARD_BYTES = 8 << 20  # text whose windows are grouped in one shard of hashes
TILE_BYTES = 6 * 14 * 8192  # text whose anchors are expected in one tile
FLUSH = 1 << 20  # anchors a task holds before it sends its sketch


class _Cells:
    """Windows of a slice of texts, their anchors and sketch cells."""

    def __init__(self, texts: pa.Array, width: int, tiles: int):
        self.words = scan(texts)
        self.hashes = self.words.hashes()
        span = min(ANCHOR, width)
        runs = run_hashes(self.hashes, span)
        self.inside = run_starts(self.words.first, width, len(self.hashes))
        per_window = width - span + 1
        if len(self.inside):
            # an anchor hash of zero would look like an empty window below
            self.least = sliding(np.maximum(runs, np.uint64(1)), per_window, np.minimum)
            masked = np.where(self.inside, self.least, np.uint64(0))
            pad = np.zeros(per_window - 1, np.uint64)
            most = sliding(np.concatenate([pad, masked, pad]), per_window, np.maximum)
            self.places = np.flatnonzero(np.maximum(runs, np.uint64(1)) == most)
            self.anchors = most[self.places]
        else:
            self.least = self.anchors = np.zeros(0, np.uint64)
            self.places = np.zeros(0, np.int64)
        self.tiles = np.uint64(tiles)

    def cell(self, anchors: np.ndarray) -> np.ndarray:
        """tile << 32 | counter of row one << 16 | counter of row two.

        Anchors are least values, all near zero, so they are scrambled first.
        """
        even = mix(anchors)
        tile = ((even >> np.uint64(32)) * self.tiles) >> np.uint64(32)
        return (tile << np.uint64(32)) | (even & np.uint64(0xFFFFFFFF))

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, places, side="right") - 1


def _sketch(width: int, tiles: int):
    def send(cells: list[np.ndarray], chunks: list[np.ndarray]) -> pa.RecordBatch:
        cell, chunk = np.concatenate(cells), np.concatenate(chunks)
        order = np.lexsort((chunk, cell))
        cell, chunk = cell[order], chunk[order]
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1])
        at = np.flatnonzero(new)
        twice = np.diff(np.append(at, len(cell))) > 1
        cell, chunk = cell[at], chunk[at]
        tile = (cell >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        ends = np.append(cut[1:], len(tile))
        low = (cell & np.uint64(0xFFFFFFFF)).astype("<u4")
        who = (chunk.astype("<u4") << np.uint32(1)) | twice.astype("<u4")
        return pa.RecordBatch.from_arrays(
            [
                pa.array(tile[cut]),
                pa.array([low[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                pa.array([who[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
            ],
            names=["tile", "cells", "chunks"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, chunks, held = [], [], 0
        for b in slices(batches, "text"):
            found = _Cells(b.column("text"), width, tiles)
            if not len(found.places):
                continue
            cells.append(found.cell(found.anchors))
            chunks.append(b.column("chunk").to_numpy(zero_copy_only=False)[found.owner(found.places)])
            held += len(found.places)
            if held >= FLUSH:
                yield send(cells, chunks)
                cells, chunks, held = [], [], 0
        if held:
            yield send(cells, chunks)

    return run


def _merge(group: pa.Table) -> pa.Table:
    """Sum the partition sketches of one tile; return, for each chunk, the
    cells whose estimate (the lesser of the two counters) is two or more."""
    tile = group.column("tile")[0].as_py()
    low = np.frombuffer(b"".join(group.column("cells").to_pylist()), "<u4")
    who = np.frombuffer(b"".join(group.column("chunks").to_pylist()), "<u4")
    add = 1 + (who & np.uint32(1))
    rows = [(low >> np.uint32(16)).astype(np.int64), (low & np.uint32(0xFFFF)).astype(np.int64)]
    hot = np.minimum(*(np.bincount(r, add, 1 << 16)[r] for r in rows)) >= 2
    chunk, low = (who[hot] >> np.uint32(1)).astype(np.uint64), low[hot]
    both = np.unique((chunk << np.uint64(32)) | low)
    chunk = (both >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])) if len(chunk) else np.zeros(0, np.int64)
    cells = (both & np.uint64(0xFFFFFFFF)) | np.uint64(tile << 32)
    ends = np.append(cut[1:], len(chunk))
    return pa.table(
        {
            "chunk": pa.array(chunk[cut], pa.int32()),
            "cells": pa.array([cells[a:b].astype("<u8").tobytes() for a, b in zip(cut, ends)], pa.binary()),
        }
    )


def _in_order(docs: pa.Table) -> pa.Table:
    # the place of a document in its chunk is the same in both passes
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if docs.num_rows else docs


class _Candidates:
    """Windows of a chunk whose anchors are estimated at two or more.

    ``a`` and ``b`` are the two halves of each distinct window's hash in
    ascending order, the lowest bit of ``b`` set if the chunk has the window
    more than once; ``back`` leads from the places (doc, word) to them.  Both
    passes over a chunk find the same candidates in the same order.
    """

    def __init__(self, docs: pa.Table, answers: pa.Table, width: int, tiles: int):
        hot = np.sort(np.frombuffer(b"".join(answers.column("cells").to_pylist()), "<u8"))
        parts, base = [], 0
        for b in slices(iter(docs.select(["text"]).combine_chunks().to_batches()) if len(hot) else iter(()), "text"):
            found = _Cells(b.column("text"), width, tiles)
            if len(found.inside):
                # estimate each anchor once, then carry it to its windows
                unique = np.unique(found.anchors)
                cell = found.cell(unique)
                at = np.minimum(np.searchsorted(hot, cell), len(hot) - 1)
                keep = unique[hot[at] == cell]
                if len(keep):
                    at = np.minimum(np.searchsorted(keep, found.least), len(keep) - 1)
                    start = np.flatnonzero(found.inside & (keep[at] == found.least))
                    a, c = (run_hashes(found.hashes, width, m)[start] for m in (RUN_A, RUN_B))
                    doc = found.owner(start)
                    parts.append((a, c, doc + base, start - found.words.first[doc]))
            base += b.num_rows
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        a, c, self.doc, self.word = (np.concatenate(x) for x in zip(empty, *parts))
        order = np.lexsort((c, a))
        a, c = a[order], c[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        times = np.diff(np.append(np.flatnonzero(new), len(order)))
        self.back = np.empty(len(order), np.int64)
        self.back[order] = np.cumsum(new) - 1
        self.a = a[new]
        self.b = (c[new] & ~np.uint64(1)) | (times > 1).astype(np.uint64)

    def edges(self, shards: int) -> np.ndarray:
        """Where each shard's range of ``a`` begins, and the end."""
        limits = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
        return np.concatenate([[0], np.searchsorted(self.a, limits), [len(self.a)]]).astype(np.int64)


def _windows(width: int, tiles: int, shards: int):
    """Pass two: the candidates of a chunk, sixteen bytes each, by shard."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found = _Candidates(_in_order(docs), answers, width, tiles)
        edges = found.edges(shards)
        shard = np.flatnonzero(np.diff(edges))
        both = np.stack([found.a, found.b], axis=1).astype("<u8")
        return pa.table(
            {
                "shard": pa.array(shard, pa.int64()),
                "chunk": pa.array(np.full(len(shard), docs.column("chunk")[0].as_py() if docs.num_rows else 0), pa.int32()),
                "windows": pa.array([both[edges[k] : edges[k + 1]].tobytes() for k in shard], pa.binary()),
            }
        )

    return run


def _exact(group: pa.Table) -> pa.Table:
    """Group the windows of one shard by their whole hash; for each chunk, one
    bit per window that it sent: does the window start anywhere else."""
    sent = [np.frombuffer(x.as_py(), "<u8").reshape(-1, 2) for x in group.column("windows")]
    both = np.concatenate(sent)
    a, b = both[:, 0], both[:, 1] & ~np.uint64(1)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    again = np.empty(len(a), bool)
    again[order] = np.diff(np.append(np.flatnonzero(new), len(a)))[np.cumsum(new) - 1] > 1
    again |= (both[:, 1] & np.uint64(1)) > 0
    ends = np.cumsum([len(x) for x in sent])
    return pa.table(
        {
            "chunk": group.column("chunk"),
            "shard": group.column("shard"),
            "cells": pa.array([np.packbits(again[e - len(x) : e]).tobytes() for x, e in zip(sent, ends)], pa.binary()),
        }
    )


def _cut(width: int, tiles: int, shards: int):
    """Pass three: the candidates again, the bits that came back, the cut."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _in_order(docs)
        shard = answers.column("shard").to_numpy()
        found = _Candidates(docs, answers.filter(pa.array(shard < 0)), width, tiles)
        edges, again = found.edges(shards), np.zeros(len(found.a), bool)
        for k, bits in zip(shard.tolist(), answers.column("cells")):
            if k >= 0:
                n = int(edges[k + 1] - edges[k])
                again[edges[k] : edges[k + 1]] = np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=n)
        repeated = again[found.back]
        doc, word = found.doc[repeated], found.word[repeated]
        edges = np.searchsorted(doc, np.arange(docs.num_rows + 1))
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(docs.column("text").cast(pa.binary())):
            words = (text.as_py() or b"").split()
            n_words.append(len(words))
            if edges[i] == edges[i + 1]:
                n_removed.append(0)
            else:
                step = np.zeros(len(words) + 1, np.int64)
                at = word[edges[i] : edges[i + 1]]
                np.add.at(step, at, 1)
                np.add.at(step, at + width, -1)
                keep = np.cumsum(step[:-1]) == 0
                n_removed.append(int(len(words) - keep.sum()))
                words = list(compress(words, keep.tolist()))
            kept.append(b" ".join(words))
        return pa.table(
            [docs.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )

    return run


def _digest(run):
    def digest(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = run(docs, answers)
        sums = [hashlib.sha256(x.as_py()).hexdigest() for x in out.column("kept")]
        return out.drop_columns(["kept"]).append_column("kept_sha256", pa.array(sums, pa.string()))

    return digest


def _text(run):
    def text(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = run(docs, answers)
        return out.drop_columns(["kept"]).append_column("text", out.column("kept").cast(pa.string()))

    return text


def drop_repeated_windows(docs: DataFrame, width: int = WIDTH, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word is removed if a
    window of ``width`` words that covers it also starts anywhere else, in
    another row or the same one, judged on the input.  ``text`` is the kept
    words joined by one space; with ``digest`` it is replaced by kept_sha256,
    the lowercase hex SHA-256 of its UTF-8 bytes.

    Null and empty texts have no words and give an empty text; texts shorter
    than a window keep all.  Every row counts as a document of its own, also
    if its doc_id is null or repeated.  Only doc_id and text are read.
    """
    docs = wide_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, tiles, shards = 1 + size // CHUNK_BYTES, 1 + size // TILE_BYTES, 1 + size // SHARD_BYTES
    placed = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    sketches = placed.select("chunk", "text").mapInArrow(_sketch(width, tiles), "tile long, cells binary, chunks binary")
    # read by both passes that follow
    answers = staged(sketches.groupBy("tile").applyInArrow(_merge, "chunk int, cells binary"), "sketch-answers")
    windows = placed.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    windows = windows.applyInArrow(_windows(width, tiles, shards), "shard long, chunk int, windows binary")
    bits = windows.groupBy("shard").applyInArrow(_exact, "chunk int, shard long, cells binary")
    back = answers.withColumn("shard", F.lit(-1).cast("long")).unionByName(bits)
    last, kind = (_digest, "kept_sha256 string") if digest else (_text, "text string")
    return placed.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        last(_cut(width, tiles, shards)), f"doc_id long, n_words long, n_removed long, {kind}"
    )
