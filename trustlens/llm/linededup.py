"""Removal of repeated runs of lines, by a suffix array over line ids.

Every document is a sequence of line ids.  Suffixes are ranked by distributed
prefix doubling: the rank by 2k lines is the rank of the pair (rank by k lines
here, rank by k lines k further on).  Ranks of one value are an interval of
the suffix array whose common prefix has that many lines; an interval of one
suffix cannot take part in any repeated run and leaves the job, so every round
handles less.  Doubling stops at the least run length that counts: a maximal
repeated run is the union of the windows of that length in intervals of two or
more.  In each interval the first window in document order stays, the lines of
the later ones are deleted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from .storage import bounded_broadcast, staged, wide_rows

MIN_LINES = 3
CHUNK_BYTES = 8 << 20
LINE_BITS = 24  # lines of a document are numbered below 2**24


def _in_order(docs: pa.Table) -> pa.Table:
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _lines(docs: pa.Table) -> pa.Table:
    """One row per line that is not blank; blank lines are not numbered."""
    docs = _in_order(docs)
    chunk = docs.column("chunk")[0].as_py()
    doc, line, digests = [], [], []
    for i, text in enumerate(docs.column("text").cast(pa.binary())):
        n = 0
        for x in (text.as_py() or b"").split(b"\n"):
            if x.strip():
                doc.append(i)
                line.append(n)
                digests.append(hashlib.blake2b(x, digest_size=16).digest())
                n += 1
    ids = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.table(
        {
            "chunk": pa.array(np.full(len(doc), chunk), pa.int32()),
            "doc": pa.array(doc, pa.int32()),
            "doc_id": docs.column("doc_id").take(pa.array(doc, pa.int64())),
            "line": pa.array(line, pa.int32()),
            "a": pa.array(ids[:, 0]),
            "b": pa.array(ids[:, 1]),
        }
    )


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes (at, keys) whose keys occur twice or more, keys replaced by
    their rank: the intervals of the suffix array at this depth."""
    classes = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    classes = staged(global_row_number(classes.select(*keys), [F.col(k) for k in keys], "rank"), "intervals")
    return staged(suffixes.join(bounded_broadcast(classes), keys).select("at", "rank"), "suffixes")


def _pairs(ranked: DataFrame, ahead: int) -> DataFrame:
    """(at, here, there): a suffix's rank and the rank ``ahead`` lines on in
    its document; suffixes without one cannot be repeated that far."""
    further = Window.partitionBy(F.shiftright("at", LINE_BITS)).orderBy("at").rangeBetween(ahead, ahead)
    return ranked.select("at", F.col("rank").alias("here"), F.first("rank").over(further).alias("there")).where("there is not null")


def repeated_windows(lines: DataFrame, min_lines: int) -> DataFrame:
    """(at, rank, first_at) of all windows of ``min_lines`` lines that occur
    twice or more, from rows (at, a, b): position and 128-bit line id."""
    ranked, depth = _ranked(lines.select("at", "a", "b"), ["a", "b"]), 1
    while depth < min_lines:
        # the last step overlaps where the length is no power of two
        ahead = min(depth, min_lines - depth)
        ranked = _ranked(_pairs(ranked, ahead), ["here", "there"])
        depth += ahead
    first = staged(ranked.groupBy("rank").agg(F.min("at").alias("first_at")), "first-windows")
    return ranked.join(bounded_broadcast(first), "rank")


def _cut(min_lines: int, digest: bool):
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        docs = _in_order(docs)
        doc, line = (marks.column(c).to_numpy() for c in ("doc", "line"))
        order = np.argsort(doc, kind="stable")
        doc, line = doc[order], line[order]
        edges = np.searchsorted(doc, np.arange(docs.num_rows + 1))
        total, removed, texts = [], [], []
        for i, text in enumerate(docs.column("text").cast(pa.binary())):
            lines = (text.as_py() or b"").split(b"\n")
            gone = {k + j for k in line[edges[i] : edges[i + 1]].tolist() for j in range(min_lines)}
            kept, n = [], 0
            for x in lines:
                if x.strip():
                    n += 1
                    if n - 1 in gone:
                        continue
                kept.append(x)
            total.append(n)
            removed.append(len(gone))
            out = b"\n".join(kept)
            texts.append(hashlib.sha256(out).hexdigest() if digest else out.decode())
        return pa.table(
            [docs.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_lines", "n_removed", "kept_sha256" if digest else "text"],
        )

    return run


def drop_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, digest: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) for every row of ``docs``.

    Lines end at a line feed; blank ones (white space only) stay and count for
    nothing.  A run of ``min_lines`` or more lines, blank ones between them
    ignored, that occurs more than once keeps its first copy in order of
    (doc_id, line) - null ids last - and loses the lines of all later copies,
    within a document too.  ``n_lines`` and ``n_removed`` count lines that are
    not blank; with ``digest`` the text is replaced by kept_sha256, the hex
    SHA-256 of its UTF-8 bytes.

    Null and empty texts give an empty text; documents of fewer lines lose
    none.  Every row is a document of its own; rows of one doc_id come in an
    order of their texts' hashes.  Only doc_id and text are read.
    """
    docs = wide_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = 1 + size // CHUNK_BYTES
    placed = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    lines = staged(
        placed.groupBy("chunk").applyInArrow(_lines, "chunk int, doc int, doc_id long, line int, a long, b long"), "lines"
    )
    heads = lines.where("line = 0").select("chunk", "doc", "doc_id")
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("chunk"), F.col("doc")]
    places = staged(global_row_number(heads, order, "place").select("chunk", "doc", "place"), "document-order")
    at = F.shiftleft("place", LINE_BITS) + F.col("line")
    lines = lines.join(places, ["chunk", "doc"]).select("chunk", "doc", "line", at.alias("at"), "a", "b")
    windows = repeated_windows(lines, min_lines).where("at <> first_at")
    later = windows.select(F.shiftright("at", LINE_BITS).alias("place"), F.col("at").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int").alias("line"))
    later = later.join(places, "place").select("chunk", "doc", "line")
    kind = "kept_sha256 string" if digest else "text string"
    return placed.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(
        _cut(min_lines, digest), f"doc_id long, n_lines long, n_removed long, {kind}"
    )
