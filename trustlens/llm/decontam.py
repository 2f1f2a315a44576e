"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (four consecutive words,
folded to lower case, punctuation dropped) are tiled: the longest match of
unmarked words is marked in both, again and again, until none of four words is
left.  Matches of a length are found by running Karp-Rabin hashes over windows
of that length, the longest length by bisection.  The share of the item's words
under tiles does not depend on the order of the pieces, so a passage whose
sentences were moved around is caught as well as a verbatim one.  Of a long
item one tile of many words is enough, however small its share.

The benchmark is the query set: it goes to every task in blocks of bounded
size, and documents are neither shuffled nor paired with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import slices, staged, wide_rows
from .textscan import Words, run_hashes, run_starts, scan_bytes, text_bytes

MATCH = 4  # words in the shortest tile
COVERAGE = 0.5
PASSAGE = 30  # words of one tile that are a leak by themselves
BLOCK_BYTES = 8 << 20
SEED_ROWS = 1 << 18  # places of items looked at together, whole texts at least (each place of a block once)
_FILTER = 22  # bits of the filter ahead of the seed table


def plain_words(texts: pa.Array) -> Words:
    """Words of letters, digits and non-ASCII bytes, A-Z folded."""
    data, off = text_bytes(texts)
    low = data | np.uint8(32)
    word = (low - np.uint8(97) < 26) | (data - np.uint8(48) < 10) | (data > 127)
    data = np.where(word, np.where(low - np.uint8(97) < 26, low, data), np.uint8(32))
    return scan_bytes(data, off)


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, length) of two sequences of
    word hashes: always the longest match of unmarked words, then the first
    place in the item, then in the text.  Where words match at a length they
    match at every lower one, so the longest length is found by bisection."""
    out: list[tuple[int, int, int]] = []
    free_a, free_b = np.ones(len(item), bool), np.ones(len(text), bool)
    size = min(len(item), len(text))
    while (size := min(size, _longest(free_a), _longest(free_b))) >= shortest:
        met = _first_match(item, text, free_a, free_b, size)
        if met is None:
            low, size = shortest, size - 1
            while low <= size:  # a match of fewer than ``low`` words is known, none of more than ``size``
                middle = (low + size) // 2
                here = _first_match(item, text, free_a, free_b, middle)
                if here is None:
                    size = middle - 1
                else:
                    low, met = middle + 1, here
        if met is None:
            break
        i, j = met
        out.append((i, j, size))
        free_a[i : i + size] = free_b[j : j + size] = False
    return out


def _first_match(item: np.ndarray, text: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, size: int) -> tuple[int, int] | None:
    """The first place in the item, then in the text, of ``size`` equal unmarked words."""
    ha, hb = run_hashes(item, size), run_hashes(text, size)
    open_a, open_b = np.flatnonzero(_all_free(free_a, size)), np.flatnonzero(_all_free(free_b, size))
    open_b = open_b[np.isin(hb[open_b], ha[open_a])]
    for i in open_a[np.isin(ha[open_a], hb[open_b])].tolist():
        for j in open_b[hb[open_b] == ha[i]].tolist():
            if np.array_equal(item[i : i + size], text[j : j + size]):
                return i, j
    return None


def _longest(free: np.ndarray) -> int:
    """Length of the longest unmarked stretch."""
    return int(np.diff(np.concatenate([[-1], np.flatnonzero(~free), [len(free)]])).max()) - 1


def _all_free(free: np.ndarray, size: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(free)])
    return total[size:] - total[:-size] == size


class Benchmark:
    """A block of items as word hashes, with a table of their seeds."""

    def __init__(self, ids: list[int], texts: list[str]):
        w = plain_words(pa.array(texts, pa.string()))
        hashes = w.hashes()
        self.ids = ids
        self.items = [hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        seeds = run_hashes(hashes, MATCH)
        at = np.flatnonzero(run_starts(w.first, MATCH, len(hashes)))
        owner = np.searchsorted(w.first, at, side="right") - 1
        order = np.argsort(seeds[at], kind="stable")
        self.seeds, self.owner = seeds[at][order], owner[order]
        self.place = (at - w.first[owner])[order]
        self.values, self.first = np.unique(self.seeds, return_index=True)
        self.many = np.diff(self.first, append=len(self.seeds))
        self.filter = np.zeros(1 << _FILTER, bool)
        self.filter[(self.seeds >> np.uint64(64 - _FILTER)).astype(np.int64)] = True

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, float, int]]:
        """(text number, item id, coverage, words in the longest tile) wherever
        a text and an item may reach the coverage or the passage that matters;
        others share too few seeds."""
        w = plain_words(texts)
        hashes = w.hashes()
        runs = run_hashes(hashes, MATCH)
        at = np.flatnonzero(run_starts(w.first, MATCH, len(hashes)) & self.filter[(runs >> np.uint64(64 - _FILTER)).astype(np.int64)])
        value = np.searchsorted(self.values, runs[at])
        met = self.values[np.minimum(value, len(self.values) - 1)] == runs[at] if len(self.values) else np.zeros(len(at), bool)
        at, value = at[met], value[met]
        if not len(at):
            return
        # every seed once for each text, however often it occurs there: a text
        # meets a place of an item at most once
        text = np.searchsorted(w.first, at, side="right") - 1
        key = np.unique(text * len(self.values) + value)
        own, seed = np.divmod(key, len(self.values))
        # texts in groups, so that a seed that many items share stays bounded
        new = np.flatnonzero(np.diff(own, prepend=-1))
        met = np.add.reduceat(self.many[seed], new)
        group = (np.cumsum(met) - met) // SEED_ROWS
        edges = [*new[np.diff(group, prepend=-1) > 0].tolist(), len(own)]
        for a, b in zip(edges[:-1], edges[1:]):
            x, y = np.searchsorted(text, [own[a], own[b - 1] + 1])
            yield from self._tiled(hashes, at[x:y], text[x:y], value[x:y], own[a:b], seed[a:b])

    def _tiled(
        self, hashes: np.ndarray, at: np.ndarray, at_text: np.ndarray, at_value: np.ndarray, own: np.ndarray, value: np.ndarray
    ) -> Iterator[tuple[int, int, float, int]]:
        # one row for each place of an item that a text meets
        many = self.many[value]
        seed = np.repeat(self.first[value] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        text, item = np.repeat(own, many), self.owner[seed]
        order = np.lexsort((item, text))
        item, text, seed = item[order], text[order], seed[order]
        cut = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1])]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(text)]):
            words = self.items[item[a]]
            reach = np.zeros(len(words), bool)
            for k in range(MATCH):
                reach[self.place[seed[a:b]] + k] = True
            if reach.sum() < COVERAGE * len(words) and not (len(words) >= PASSAGE and _all_free(reach, PASSAGE).any()):
                continue
            # only words under a seed can be tiled; a gap stays a gap
            x, y = np.searchsorted(at_text, [text[a], text[a] + 1])
            place = at[x:y][np.isin(at_value[x:y], np.searchsorted(self.values, self.seeds[seed[a:b]]))]
            near = np.unique((place[:, None] + np.arange(MATCH)).ravel())
            gap = np.flatnonzero(np.diff(near) > 1) + 1
            piece = np.insert(hashes[near], gap, np.uint64(0))
            found = [n for _, _, n in tiles(words, piece)]
            yield int(text[a]), self.ids[item[a]], sum(found) / len(words), max(found, default=0)


def _update(ids: list[int], texts: list[str], bar: float, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(ids, texts)
        for b in slices(batches, "plain"):
            item, share, leak = (b.column(c).to_pylist() for c in ("item_id", "coverage", "contaminated"))
            for i, found, covered, longest in bench.matches(b.column("plain")):
                bad = covered >= bar or longest >= PASSAGE
                if (bad, covered) > (leak[i], share[i]) or (bad, covered) == (leak[i], share[i]) and covered and found < item[i]:
                    item[i], share[i], leak[i] = found, covered, bad
            at = b.schema.get_field_index
            b = b.set_column(at("item_id"), "item_id", pa.array(item, pa.int64()))
            b = b.set_column(at("coverage"), "coverage", pa.array(share, pa.float64()))
            b = b.set_column(at("contaminated"), "contaminated", pa.array(leak, pa.bool_()))
            yield b.drop_columns(["plain"]) if last else b

    return run


def _covered(docs: DataFrame, benchmark: DataFrame, bar: float, keep) -> DataFrame:
    """``docs`` as (kept columns, item_id, coverage, contaminated): the item
    that a text leaks, else covers, most, the least item_id of several, null
    and 0.0 for none."""
    none = [F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("coverage"), F.lit(False).alias("contaminated")]
    rows = wide_rows(docs).select(keep, F.lower("text").alias("plain"), *none)
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    items = items.withColumn("bytes", F.octet_length("text"))
    size = items.agg(F.sum("bytes")).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    items = staged(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "benchmark")
    for block in range(blocks):
        got = items.where(F.col("block") == block).orderBy("item_id", "text").collect()
        last = block == blocks - 1
        schema = rows.drop("plain").schema if last else rows.schema
        rows = rows.mapInArrow(_update([r.item_id for r in got], [r.text for r in got], bar, last), schema)
    return rows


def find_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, contaminated) for every row of ``docs``.

    ``coverage`` is the share of a benchmark item's words that tiles of at
    least four words cover in the text, for the item with the highest share
    (the least item_id of equals); contaminated if it is ``coverage`` or more,
    or if one tile has thirty words or more, whatever the item's length.  Items
    that contaminate come before others.  Where no item can reach 0.5 or such
    a tile, item_id is null and the share 0.0.

    Null and empty texts are clean.  Items that are null, have a null id or
    fewer than four words match nothing; an empty benchmark leaves all clean.
    Every row stands for itself, also with a null or repeated doc_id.
    """
    if coverage < COVERAGE:
        raise ValueError(f"coverage must be at least {COVERAGE}")
    return _covered(docs, benchmark, coverage, F.col("doc_id").cast("long").alias("doc_id"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    return _covered(docs, benchmark, coverage, whole).where(~F.col("contaminated")).select("_row.*")
