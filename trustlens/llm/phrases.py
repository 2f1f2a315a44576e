"""Phrase collocations of a corpus, by counting quotient filters.

A phrase is a run of words of one piece (no sentence mark or line end between
them).  Words have 64-bit ids, hashes under a seed for which no two words of
the corpus share one (checked by a second hash of every word).  Every task
counts the n-grams of its documents in filters (``quotient``): sorted, exact
and compact; a filter is sent per language and shard of the key space, and the
filters of a shard are merged into one.  A word or phrase that makes up a third
of the corpus is one entry per task.

Lengths are counted one after another.  An n-gram is as frequent as the bar
asks only if its two (n-1)-grams are, so a bitmap of the frequent ones, of
bounded size, keeps most of the rest out of the filters; it may let a rare one
through, never the reverse, and what comes through is counted exactly.

What follows is joins and windows over the frequent phrases: cut scores in
exact decimal arithmetic, phrases covered by longer ones dropped, and the best
of each language ranked in two rounds, so that no task holds a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quotient import count_keys, merge, permute, restore, split
from .storage import slices, staged, wide_rows
from .textscan import Words, mix, text_bytes
from .wordscan import Pieces, byte_classes, scan_pieces

MAX_WORDS = 3
MIN_COUNT = 10
COVERED_PERCENT = 50
PER_LANGUAGE = 2000
SCORE_SCALE = 1_000_000

FLUSH = 1 << 21  # keys a task holds before it sends its filters
SHARD_KEYS = 1 << 20  # n-gram places that one shard of filters stands for
MAX_SHARD_BITS = 24
RANK_ROWS = 100_000  # candidates ranked together in the first round
# The frequent bitmap: 2^15 bits for each of at most 2^13 buckets, 32 MB.
BUCKET_BITS, MAX_BUCKET_BITS = 15, 13

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")


def word_ids(words: Words, seed: int) -> np.ndarray:
    """64-bit ids; another seed is another hash function."""
    return Words(words.data ^ np.uint8(seed), words.start, words.length, words.first).hashes()


def _column(col: pa.Array) -> pa.Array:
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


class _Bitmap:
    """Which keys may be frequent: one bit per hash of language and key."""

    def __init__(self, buckets: dict[int, bytes], bucket_bits: int):
        self.mask = np.uint64((1 << (bucket_bits + BUCKET_BITS)) - 1)
        bits = np.zeros(((1 << bucket_bits), (1 << BUCKET_BITS) // 8), np.uint8)
        for b, raw in buckets.items():
            bits[b] = np.frombuffer(raw, np.uint8)
        self.bytes = bits.ravel()

    def holds(self, place: np.ndarray) -> np.ndarray:
        at = place & self.mask
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _place(lang_hash: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Where a permuted key of a language stands in the bitmap."""
    return mix(head ^ lang_hash)


def _lang_codes(col: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, code of each row, hash of each language); null is ``und``."""
    coded = pc.fill_null(_column(col).cast(pa.string()), "und").dictionary_encode()
    names = coded.dictionary
    data, off = text_bytes(names)
    # a language is hashed as one word, whatever bytes it has
    whole = Words(data, off[:-1], np.diff(off), np.arange(len(off)))
    return names.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), whole.hashes()


def _ngrams(found: Pieces, ids: np.ndarray, n: int, seed: int, lang_of_row: np.ndarray, allowed: _Bitmap | None):
    """(permuted lanes, row) of the n-grams whose parts may be frequent."""
    at = found.together(n)
    if allowed is not None and len(at):
        # all (n-1)-grams, looked up once for each place
        m = max(0, len(ids) - n + 2)
        head = permute([ids[j : j + m] for j in range(n - 1)])[0]
        ok = allowed.holds(_place(lang_of_row[found.row[:m]], head))
        at = at[ok[at] & ok[at + 1]]
    return permute([ids[at + j] for j in range(n)]), found.row[at]


def _count(n: int, seed: int, shard_bits: int, allowed=None):
    """Tasks: documents to rows (lang, shard, total, filter).

    For single words a second hash stands beside the id, to prove ids unique.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[list[np.ndarray]]] = {}
        size = 0
        bitmap = allowed.value if allowed is not None else None

        def send():
            rows = []
            for lang, parts in held.items():
                keys, counts = count_keys([np.concatenate(x) for x in zip(*parts)])
                for shard, blob in split(keys, counts, shard_bits):
                    rows.append((lang, shard, blob))
            held.clear()
            for a in range(0, len(rows), 256):
                lang, shard, blob = zip(*rows[a : a + 256])
                yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(shard, pa.int64()), pa.array(blob, pa.binary())], names=["lang", "shard", "filter"])

        for b in slices(batches, "text", 4 << 20):
            found = scan_pieces(b.column("text"), CLASSES)
            names, code, lang_hash = _lang_codes(b.column("lang"))
            ids = word_ids(found.words, seed)
            if n == 1:
                # keys of one id stand together, whatever their second hash
                lanes, row = [*permute([ids]), word_ids(found.words, seed ^ 0xA5)], found.row
            else:
                lanes, row = _ngrams(found, ids, n, seed, lang_hash[code], bitmap)
            key_code = code[row]
            order = np.argsort(key_code, kind="stable")
            at = np.searchsorted(key_code[order], np.arange(len(names) + 1))
            for i, name in enumerate(names):
                if at[i] < at[i + 1]:
                    pick = order[at[i] : at[i + 1]]
                    held.setdefault(name, []).append([lane[pick] for lane in lanes])
            size += len(row)
            if size >= FLUSH:
                yield from send()
                size = 0
        yield from send()

    return run


def _merged(n: int, min_count: int):
    """Groups: the filters of a language's shard to its frequent n-grams.

    ``total`` is all the shard counted, rare ones too (in its first row).
    """

    def run(group: pa.Table) -> pa.Table:
        keys, counts = merge([x.as_py() for x in group.column("filter")])
        clash = 0
        if n == 1:  # words that share an id
            clash = int((keys[0][1:] == keys[0][:-1]).sum())
        place, lanes = keys[0], restore(keys[:n])
        lang = group.column("lang")[0].as_py()
        total = int(counts.sum())
        often = np.flatnonzero(counts >= min_count)
        _, _, lang_hash = _lang_codes(pa.array([lang]))
        # the first row is the shard's own: no words, its total and clashes
        rows = len(often) + 1
        head = lambda first, rest: np.concatenate([[first], rest])
        cols = [pa.array([lang] * rows), pa.array(head(total, counts[often])), pa.array(head(clash, np.zeros(len(often), np.int64)))]
        cols.append(pa.array(head(0, _place(lang_hash, place[often]).view(np.int64))))
        for lane in lanes:
            cols.append(pa.array(head(0, lane[often].view(np.int64)), mask=np.arange(rows) == 0))
        return pa.table(cols, names=["lang", "f", "clash", "place", *(f"w{j}" for j in range(1, n + 1))])

    return run


def _counted(docs: DataFrame, n: int, seed: int, shard_bits: int, min_count: int, allowed=None) -> DataFrame:
    filters = docs.mapInArrow(_count(n, seed, shard_bits, allowed), "lang string, shard long, filter binary")
    words = ", ".join(f"w{j} long" for j in range(1, n + 1))
    found = filters.groupBy("lang", "shard").applyInArrow(_merged(n, min_count), f"lang string, f long, clash long, place long, {words}")
    return staged(found, f"phrases-{n}")


def _bitmap(frequent: DataFrame) -> _Bitmap:
    """Bitmap of the keys' places: a bounded number of buckets of 4 KB."""
    n = max(1, frequent.count())
    bucket_bits = min(MAX_BUCKET_BITS, max(0, (16 * n).bit_length() - BUCKET_BITS))
    bit = F.col("place").bitwiseAND(F.lit((1 << (bucket_bits + BUCKET_BITS)) - 1))
    # the built-in numbers buckets and bits from one
    rows = frequent.select(bit.alias("bit")).groupBy(F.shiftright("bit", BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("bits")
    )
    return _Bitmap({r.bucket: bytes(r.bits) for r in rows.collect()}, bucket_bits)


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, shard_bits: int | None = None) -> tuple[dict[int, DataFrame], DataFrame, int]:
    """({n: (lang, f, w1..wn) of every n-gram that occurs ``min_count`` times in
    its language}, (lang, n) of all words, seed of the ids)."""
    spark = docs.sparkSession
    rows = wide_rows(docs).select("text", F.col("lang").cast("string").alias("lang"))
    if shard_bits is None:
        places = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # words have some five bytes; a power of two of shards
        shard_bits = min(MAX_SHARD_BITS, max(0, (places // 5 // SHARD_KEYS).bit_length()))
    for seed in range(256):
        words = _counted(rows, 1, seed, shard_bits, min_count)
        if not words.where("clash > 0").limit(1).count():
            break
    shard_row = F.col("w1").isNull()
    totals = words.where(shard_row).groupBy("lang").agg(F.sum("f").alias("n"))
    tables = {1: words.where(~shard_row)}
    for n in range(2, max_words + 1):
        allowed = spark.sparkContext.broadcast(_bitmap(tables[n - 1]))
        tables[n] = _counted(rows, n, seed, shard_bits, min_count, allowed).where(~shard_row)
    return {n: t.select("lang", "f", *(f"w{j}" for j in range(1, n + 1))) for n, t in tables.items()}, totals, seed


def _part(tables: dict[int, DataFrame], at: int, size: int, name: str) -> DataFrame:
    """Counts of ``size``-word phrases, to be joined on words ``at + 1`` on."""
    t = tables[size]
    return t.select("lang", F.col("f").alias(name), *(F.col(f"w{j}").alias(f"w{at + j}") for j in range(1, size + 1)))


def _exact(c: Column) -> Column:
    return c.cast("decimal(16,0)")


def _candidates(tables: dict[int, DataFrame], n: int) -> DataFrame:
    """n-word phrases with their lowest-scoring cut: a, l, r, score."""
    have = tables[n].withColumnRenamed("f", "a")
    for k in range(1, n):
        left, right = _part(tables, 0, k, f"l{k}"), _part(tables, k, n - k, f"r{k}")
        # both parts are as frequent as the phrase, so neither is missing
        have = have.join(left, ["lang", *(f"w{j}" for j in range(1, k + 1))])
        have = have.join(right, ["lang", *(f"w{j}" for j in range(k + 1, n + 1))])
    a = _exact(F.col("a"))
    cuts = []
    for k in range(1, n):
        square = F.lit(SCORE_SCALE).cast("decimal(7,0)") * (a * a)
        have = have.withColumn(f"_n{k}", square).withColumn(f"_d{k}", _exact(F.col(f"l{k}")) * _exact(F.col(f"r{k}")))
        cuts.append(F.struct(F.expr(f"_n{k} div _d{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    words = F.array(*(F.col(f"w{j}") for j in range(1, n + 1)))
    return have.select("lang", words.alias("words"), "a", best.alias("c")).select("lang", "words", "a", "c.l", "c.r", "c.score")


def _uncovered(tables: dict[int, DataFrame], n: int, found: DataFrame, covered_percent: int) -> DataFrame:
    """``found`` without the phrases that some longer one covers."""
    longer = None
    for m in range(n + 1, max(tables) + 1):
        subs = F.array(*(F.array(*(F.col(f"w{j}") for j in range(s, s + n))) for s in range(1, m - n + 2)))
        part = tables[m].select("lang", "f", F.explode(subs).alias("words"))
        longer = part if longer is None else longer.unionByName(part)
    if longer is None:
        return found
    most = longer.groupBy("lang", "words").agg(F.max("f").alias("most"))
    joined = found.join(most, ["lang", "words"], "left")
    kept = F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(covered_percent) * F.col("a"))
    return joined.where(kept).drop("most")


def _first_per_language(found: DataFrame, order: list[Column], k: int, ties: bool) -> DataFrame:
    """The first ``k`` rows of each language, in two rounds: within groups of
    rows first, then among what those left."""
    rank = F.rank() if ties else F.row_number()
    groups = max(1, -(-found.count() // RANK_ROWS))
    salted = found.withColumn("_tl_salt", F.pmod(F.xxhash64("words"), F.lit(groups)))
    near = Window.partitionBy("lang", "_tl_salt").orderBy(*order)
    some = salted.withColumn("rank", rank.over(near)).where(F.col("rank") <= k).drop("_tl_salt", "rank")
    return some.withColumn("rank", rank.over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= k)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, id) of words to their places in a bitmap."""
    for b in batches:
        _, code, lang_hash = _lang_codes(b.column("lang"))
        ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(_place(lang_hash[code], mix(ids)).view(np.int64))], names=["place"])


def _named(docs: DataFrame, chosen: DataFrame, seed: int) -> DataFrame:
    """``chosen`` with ``phrase``: its words, found again in the documents."""
    spark = docs.sparkSession
    ids = staged(chosen.select("lang", F.explode("words").alias("id")).distinct(), "phrase-words")
    wanted = spark.sparkContext.broadcast(_bitmap(ids.mapInArrow(_places, "place long")))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(0, np.uint64)
        for b in slices(batches, "text", 4 << 20):
            pieces = scan_pieces(b.column("text"), CLASSES)
            words, (names, code, lang_hash) = pieces.words, _lang_codes(b.column("lang"))
            ids = word_ids(words, seed)
            places, at = np.unique(_place(lang_hash[code[pieces.row]], mix(ids)), return_index=True)
            maybe = wanted.value.holds(places)
            new = np.flatnonzero(maybe)[~np.isin(places[maybe], sent)]
            places, at = places[new], at[new]
            if len(sent) < FLUSH:
                sent = np.concatenate([sent, places])
            text = [words.data[words.start[i] : words.start[i] + words.length[i]].tobytes() for i in at]
            lang = [names[c] for c in code[pieces.row[at]]]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(ids[at].view(np.int64)), pa.array(text, pa.binary()).cast(pa.string())], names=["lang", "id", "word"])

    names = docs.mapInArrow(find, "lang string, id long, word string")
    names = names.join(ids, ["lang", "id"], "left_semi").groupBy("lang", "id").agg(F.min("word").alias("word"))
    long = chosen.select("lang", "words", F.posexplode("words").alias("at", "id")).join(names, ["lang", "id"])
    text = long.groupBy("lang", "words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    text = text.select("lang", "words", F.array_join(F.col("w.word"), " ").alias("phrase"))
    return chosen.join(text, ["lang", "words"])


def mine_collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    covered_percent: int = COVERED_PERCENT,
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases per language.

    Words are runs of ``[^\\x20\\x09]`` within pieces parted by ``[.,;:!?]`` and
    line ends, A-Z folded.  ``a`` counts a phrase's occurrences in documents of
    its language (null: ``und``), overlaps included, and ``n`` all words there.
    A phrase of two to ``max_words`` words is a candidate from ``min_count``
    occurrences on.  Cut after k words, its parts occur ``l`` and ``r`` times
    and it scores floor(1000000 a a / (l r)); the cut with the lowest score
    counts, the earliest of equals.  A candidate inside a longer one with at
    least ``covered_percent`` of its occurrences is dropped.  The first
    ``per_language`` by score and a, both descending, and the phrase's bytes
    are returned, ranked from 1.

    Null and empty texts have no words; repeated rows count each time; a
    language without candidates, and an empty table, give no rows.  Only text
    and lang are read, so other columns may have any name.
    """
    rows = docs.select("text", "lang")
    tables, totals, seed = frequent_phrases(rows, max_words, min_count)
    found = None
    for n in range(2, max_words + 1):
        part = _uncovered(tables, n, _candidates(tables, n), covered_percent)
        found = part if found is None else found.unionByName(part)
    found = staged(found, "phrase-candidates")
    # words are looked up for the rows that can be among the first, ties too
    chosen = _first_per_language(found, [F.desc("score"), F.desc("a")], per_language, ties=True).drop("rank")
    named = _named(rows, staged(chosen, "phrase-chosen"), seed)
    ranked = _first_per_language(staged(named, "phrase-named"), [F.desc("score"), F.desc("a"), F.asc("phrase")], per_language, ties=False)
    return ranked.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
