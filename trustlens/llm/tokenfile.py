"""Token ids of a corpus in binary shard files with a minimal perfect index.

A shard holds consecutive documents in ascending doc_id order.  Layout, all
little-endian:

    8 bytes   magic ``TLTOK02\\n``
    4 bytes   length of the header
    header    JSON: place (partition, number), counts, id width, level sizes
    keys      int64 per distinct non-null doc_id, ascending
    bits      the levels of the perfect hash, padded to bytes
    ranks     uint32 per 512 bits: set bits before them
    slots     per key: uint32 fingerprint, uint32 first row, uint32 rows, int64 key
    offsets   uint64 per row and one more: ids of the shard before the row
    payload   the ids themselves, uint16 or uint32

The index is a minimal perfect hash by levels of bit arrays: at each level a
key that has its bit alone keeps it, the others go on to the next; a key's
slot is the rank of its bit.  A lookup touches one bit per level, one stored
rank and at most 64 bytes after it, one slot and one slice of the payload; the
fingerprint turns away keys that are not there, and the stored key the rest.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import give_back, slices, staged, wide_rows
from .textscan import RUN_B, Words, mix, scan_bytes, text_bytes

MAGIC = b"TLTOK02\n"
GAMMA = 2  # bits per key and level
SHARD_BYTES = 8 << 20
CACHED_WORDS = 200_000
_PLAIN = re.compile(rb"[a-z]+\Z").match
# letters of a-z and Latin-1, which stay one piece and change by case alone
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z").match
# marks after a letter (a-z, or one of Latin-1 in UTF-8) or a digit
_TAIL = re.compile(rb"(?:(?<=[a-z0-9])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,;:!?#%&$*]+)(?=[\x20\x09-\x0d])")
_MARK = np.isin(np.arange(256), np.frombuffer(b".,;:!?#%&$*", np.uint8))
_LETTER = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))
_LATIN_TAIL = np.isin(np.arange(256), [*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)])
_TAILS = (".", ",", ";", ":", "!", "?", "?!", "...", "#", "%", "&", "$", "*", ",###", ".$$$", "%%%", "&&", "!***")
_SLOT = np.dtype([("fingerprint", "<u4"), ("row", "<u4"), ("rows", "<u4"), ("key", "<i8")])
_RANK_BYTES = 64  # of bits, for each stored rank
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)


# --- the perfect hash ---------------------------------------------------------


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + np.uint64((level + 1) * RUN_B % (1 << 64))) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(mix(keys.astype(np.uint64))) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits, slot of each key) for distinct integer keys."""
    left, sizes, levels = np.arange(len(keys)), [], []
    where = np.zeros(len(keys), np.int64)
    base = 0
    while len(left):
        size = max(8, GAMMA * len(left))
        at = _position(keys[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        here = alone[at]
        where[left[here]] = base + at[here]
        sizes.append(size)
        levels.append(alone)
        base += size
        left = left[~here]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    return sizes, bits, (np.cumsum(bits) - 1)[where] if len(keys) else where


def block_ranks(packed: np.ndarray) -> np.ndarray:
    """Number of set bits before each block of 512."""
    ones = _ONES[packed]
    whole = np.concatenate([ones, np.zeros(-len(ones) % _RANK_BYTES, np.int64)]).reshape(-1, _RANK_BYTES).sum(1)
    return (np.cumsum(whole) - whole).astype("<u4")


def find_slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray, ranks: np.ndarray | None = None) -> np.ndarray:
    """Slot of each key, -1 where no level has a bit for it.

    ``bits`` are packed bytes with their block ranks, or plain booleans."""
    if ranks is None:
        bits = np.packbits(bits)
        ranks = block_ranks(bits)
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + _position(keys[left], level, size)
        hit = bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1
        out[left[hit]] = _rank(at[hit], bits, ranks)
        left, base = left[~hit], base + size
    return out


def _rank(at: np.ndarray, bits: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Number of set bits before each place: the block's, and those of at most
    64 bytes in it."""
    out = np.empty(len(at), np.int64)
    for a in range(0, len(at), 1 << 14):
        here = at[a : a + (1 << 14)]
        byte = here >> 3
        span = (byte // _RANK_BYTES * _RANK_BYTES)[:, None] + np.arange(_RANK_BYTES)
        before = np.where(span < byte[:, None], _ONES[bits[np.minimum(span, len(bits) - 1)]], 0).sum(1)
        rest = _ONES[bits[byte] >> (8 - (here & 7)).astype(np.uint16)]
        out[a : a + (1 << 14)] = ranks[byte // _RANK_BYTES] + before + rest
    return out


# --- shards -------------------------------------------------------------------


def pack_shard(place: tuple[int, int], ids: list[int | None], payload: np.ndarray, counts: np.ndarray) -> bytes:
    nulls = sum(x is None for x in ids)
    keys, row, rows = np.unique(np.array(ids[nulls:], np.int64), return_index=True, return_counts=True)
    sizes, bits, slot = build_index(keys)
    slots = np.zeros(len(keys), _SLOT)
    slots["fingerprint"][slot] = _fingerprint(keys)
    slots["row"][slot] = row + nulls
    slots["rows"][slot] = rows
    slots["key"][slot] = keys
    packed = np.packbits(bits)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    width = payload.dtype.itemsize
    head = json.dumps(
        {"place": list(place), "rows": len(ids), "nulls": nulls, "keys": len(keys), "width": width, "levels": sizes}
    ).encode()
    return b"".join(
        [MAGIC, len(head).to_bytes(4, "little"), head, keys.astype("<i8").tobytes(), packed.tobytes(), block_ranks(packed).tobytes()]
        + [slots.tobytes(), offsets.tobytes(), payload.astype(f"<u{width}").tobytes()]
    )


class Shard:
    """A shard file's content, sections viewed in place."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(content[8:12], "little")
        self.head = json.loads(content[12 : 12 + size])
        at = 12 + size

        def section(kind, n):
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        h = self.head
        total = sum(h["levels"])
        self.keys = section("<i8", h["keys"])
        self.bits = section(np.uint8, (total + 7) // 8)
        self.ranks = section("<u4", -(-len(self.bits) // _RANK_BYTES))
        self.slots = section(_SLOT, h["keys"])
        self.offsets = section("<i8", h["rows"] + 1)
        self.payload = section(f"<u{h['width']}", int(self.offsets[-1]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, rows) of each key; rows is 0 for keys not in the shard."""
        slot = find_slots(keys, self.head["levels"], self.bits, self.ranks)
        hit = self.slots[np.maximum(slot, 0)] if len(self.slots) else np.zeros(len(keys), _SLOT)
        there = (slot >= 0) & (hit["fingerprint"] == _fingerprint(keys)) & (hit["key"] == keys) if len(keys) else np.zeros(0, bool)
        return hit["row"].astype(np.int64), np.where(there, hit["rows"], 0).astype(np.int64)

    def ids(self, row: int) -> np.ndarray:
        return self.payload[self.offsets[row] : self.offsets[row + 1]]


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of the spans of ``size`` from ``begin`` on, one after another."""
    last = np.cumsum(size)
    return np.arange(int(last[-1]) if len(last) else 0) + np.repeat(begin - (last - size), size)


def _byte_characters() -> dict[int, int]:
    """The character that byte-level tokenizers write for each byte: itself if
    it is printable in Latin-1, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_CHARACTERS = _byte_characters()


def _byte_level(word: bytes) -> str:
    """A lower-cased word as a byte-level model reads it."""
    return word.decode().lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS)


class WordEncoder:
    """Ids of whole texts, word by word.

    Whether the tokenizer drops white space is probed; one that does not gets
    whole texts.

    For a tokenizer that drops white space and never joins across it, the ids
    of a text are those of its space-separated words one after another, so a
    word met before is not encoded again.  Where the tokenizer itself folds
    case, and parts a word from the punctuation after it, that is done first,
    and fewer words are new; words of a-z then go straight to its model.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end_id
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        # words can be taken one by one only if white space parts them and is gone
        spaced = "One two,  three\tfour\n\nfive été x1 it's (six)\r\n seven"
        self.by_words = ids(spaced) == [i for w in spaced.split() for i in ids(w)] and ids("\x0b \x0c ") == []
        self.folds = '"Lowercase"' in json.dumps(json.loads(self.tokenizer.to_str())["normalizer"])
        self.parts = all(ids(f"{w}{x} b") == ids(f"{w} {x} b") for x in _TAILS for w in ("word", "été", "Ñ", "x1"))
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.markers = [x.encode() for x in added]
        plain = ["word", "thhethea", "a", "zz", "tokenization"]
        self.direct = not any(re.fullmatch("[a-z]+", x) for x in added) and all(
            ids(x) == [t.id for t in self.tokenizer.model.tokenize(x)] for x in plain
        )
        latin = ["été", "Ñandú", "straße", "ÀÖØÞ", "àöøþÿ", "x", "über"]
        self.latin = self.direct and all(ids(x) == [t.id for t in self.tokenizer.model.tokenize(_byte_level(x.encode()))] for x in latin)
        self.kind = np.uint16 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
        self.known = {}
        self.forget()

    def forget(self) -> None:
        """Begin a new generation of words; the last one is kept beside it."""
        # entry 0 is the end of a document
        self.old = (self.known, self.flat, self.begin, self.size) if self.known else None
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, self.kind), 1
        self.flat[0] = self.end
        self.begin, self.size, self.entries = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 1
        self.size[0] = 1

    def recall(self, words: list[bytes]) -> list[bytes]:
        """Take words over from the last generation; returns the others."""
        if self.old is None:
            return words
        known, flat, begin, size = self.old
        met = [w for w in words if w in known]
        if met:
            entry = np.fromiter(map(known.__getitem__, met), np.int64, len(met))
            self.keep(met, size[entry], flat[_spans(begin[entry], size[entry])])
        return [w for w in words if w not in known]

    def _room(self, name: str, need: int) -> None:
        have = getattr(self, name)
        if need > len(have):
            setattr(self, name, np.concatenate([have, np.zeros(max(need, 2 * len(have)) - len(have), have.dtype)]))

    def learn(self, words: list[bytes]) -> None:
        tokenize = self.tokenizer.model.tokenize
        for ours, simple, text in ((self.direct, _PLAIN, bytes.decode), (self.latin, _LATIN, _byte_level)):
            if ours:
                some, rest = [], []
                for w in words:
                    (some if simple(w) else rest).append(w)
                self.keep_lists(some, [[t.id for t in tokenize(text(w))] for w in some])
                words = rest
        for a in range(0, len(words), 20_000):
            some = words[a : a + 20_000]
            self.keep_lists(some, [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)])

    def keep_lists(self, some: list[bytes], found: list[list[int]]) -> None:
        n = np.array([len(x) for x in found], np.int64)
        self.keep(some, n, np.fromiter(chain.from_iterable(found), self.kind, int(n.sum())))

    def keep(self, some: list[bytes], n: np.ndarray, ids: np.ndarray) -> None:
        """Store the ids of words, ``n`` for each."""
        total = len(ids)
        self._room("flat", self.used + total)
        self._room("begin", self.entries + len(some))
        self._room("size", self.entries + len(some))
        self.flat[self.used : self.used + total] = ids
        self.begin[self.entries : self.entries + len(some)] = self.used + np.cumsum(n) - n
        self.size[self.entries : self.entries + len(some)] = n
        self.known.update(zip(some, range(self.entries, self.entries + len(some))))
        self.used, self.entries = self.used + total, self.entries + len(some)

    def split(self, text: bytes) -> list[bytes]:
        if any(x in text for x in self.markers):  # these are matched before anything is folded
            return text.split()
        if self.folds:
            low = text.lower()
            if any(x in low for x in self.markers):  # folding would make a marker
                return text.split()
            text = low
        return (_TAIL.sub(rb" \1", text) if self.parts else text).split()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each), end ids included."""
        if not self.by_words:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            lists = [[*x.ids, self.end] for x in found]
            sizes = np.array([len(x) for x in lists], np.int64)
            return np.fromiter(chain.from_iterable(lists), self.kind, int(sizes.sum())), sizes
        if len(self.known) > CACHED_WORDS:
            self.forget()
        data, off = text_bytes(texts)
        raw = data.tobytes()
        low = raw.lower() if self.folds else raw
        if any(x in raw or x in low for x in self.markers):  # some text may hold a marker
            words, firsts = [], [0]
            for i in range(len(off) - 1):
                words += self.split(raw[off[i] : off[i + 1]])
                firsts.append(len(words))
            entry, first = self.entries_of(words), np.array(firsts)
        else:
            start, length, first = self.places(np.frombuffer(low, np.uint8), off)
            # equal words of the batch are looked up once
            _, at, back = np.unique(Words(np.frombuffer(low, np.uint8), start, length, first).hashes(), return_index=True, return_inverse=True)
            words = [low[i:j] for i, j in zip(start[at].tolist(), (start[at] + length[at]).tolist())]
            entry = self.entries_of(words)[back]
        entry = np.insert(entry, first[1:], 0)  # the end of each text
        size = self.size[entry]
        ends = np.cumsum(size)[first[1:] + np.arange(len(first) - 1)]
        return self.flat[_spans(self.begin[entry], size)], np.diff(np.concatenate([[0], ends]))

    def places(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, first word of each text) of the words of folded
        texts, with the marks after a word as one of its own."""
        found = scan_bytes(data, off)
        start, length, first = found.start, found.length, found.first
        if not (self.parts and len(start)):
            return start, length, first
        plain = np.maximum.accumulate(np.where(_MARK[data], -1, np.arange(len(data))))
        end = start + length
        stem = plain[end - 1] + 1  # end of the word without its marks
        before = data[np.maximum(stem - 1, 0)]
        latin = _LATIN_TAIL[before] & (data[np.maximum(stem - 2, 0)] == 0xC3) & (stem - 2 >= start)
        parted = (stem < end) & (stem > start) & (_LETTER[before] | latin)
        rows = np.flatnonzero(parted)
        length = np.where(parted, stem - start, length)
        start, length = np.insert(start, rows + 1, stem[rows]), np.insert(length, rows + 1, (end - stem)[rows])
        return start, length, first + np.searchsorted(rows, first)

    def entries_of(self, words: list[bytes]) -> np.ndarray:
        """Number of each word among the stored ones; new words are stored."""
        new = list(set(words).difference(self.known))
        if new:
            self.learn(self.recall(new))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def _worker_encoder(path: str, end_id: int) -> WordEncoder:
    # a Python worker serves many tasks; the words it has met stay known
    kept = sys.modules.setdefault("_trustlens_worker", types.ModuleType("_trustlens_worker")).__dict__
    if (path, end_id) not in kept:
        kept[path, end_id] = WordEncoder(path, end_id)
    return kept[path, end_id]


def _pack(tokenizer: str, end_id: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer, end_id)
        partition, number = TaskContext.get().partitionId(), 0
        ids, parts, counts, held = [], [], [], 0

        def shard():
            content = pack_shard((partition, number), ids, np.concatenate(parts), np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        for b in slices(batches, "text", min(1 << 20, shard_bytes)):
            payload, n = encoder.encode(b.column("text"))
            ids += b.column("doc_id").to_pylist()
            parts.append(payload)
            counts.append(n)
            held += payload.nbytes
            if held >= shard_bytes:
                yield shard()
                number += 1
                ids, parts, counts, held = [], [], [], 0
        if ids:
            yield shard()
        ids, parts, counts = [], [], []
        give_back()

    return run


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode ``docs`` (doc_id, text) and write shard files under ``path``.

    Rows go in ascending doc_id order, null ids first, rows of one doc_id in
    the order of a hash of their texts; every row gets ``end_id`` appended, so
    a null or empty text is that id alone.  Other columns are not read.  Files
    are written by Spark's own committer, one shard per file; an empty table
    leaves no shard.
    """
    rows = wide_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    shards = rows.mapInArrow(_pack(tokenizer, end_id, shard_bytes), "content binary")
    # the text sink writes a string's bytes as they are; the line feed after
    # the payload is outside every section
    raw = shards.select(F.col("content").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            raw = content.as_buffer()
            if not raw.size:
                continue
            shard = Shard(raw.to_pybytes())
            nulls = shard.head["nulls"]
            row, rows = shard.find(shard.keys)
            if (rows < 1).any() or int(rows.sum()) + nulls != shard.head["rows"]:
                raise ValueError(f"the index of {path} does not cover its rows")
            where = np.concatenate([np.arange(nulls), np.repeat(row - np.cumsum(rows) + rows, rows) + np.arange(rows.sum())]).astype(np.int64)
            ids = pa.array([None] * nulls + np.repeat(shard.keys, rows).tolist(), pa.int64())
            n = shard.offsets[where + 1] - shard.offsets[where]
            sums = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in where.tolist()]
            size = len(where)
            partition, number = shard.head["place"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * size, pa.string()), pa.array([partition] * size, pa.int64()), pa.array([number] * size, pa.int64())]
                + [ids, pa.array(shard.offsets[where]), pa.array(n), pa.array(sums, pa.int64())],
                names=["path", "partition", "number", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """(path, partition, number, doc_id, offset, n_tokens, ids_crc32, start) of
    every row in the shards under ``path``, each found through its shard's
    index; start counts the ids of all rows before it in the whole corpus."""
    schema = "path string, partition long, number long, doc_id long, offset long, n_tokens long, ids_crc32 long"
    rows = staged(_files(spark, [path]).mapInArrow(_documents, schema), "token-rows")
    # one row per shard: this window is as long as the list of files
    total = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    base = total.select("partition", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["partition", "number"]).withColumn("start", F.col("base") + F.col("offset")).drop("base")


def _lookup(keys: list[int]):
    wanted = np.unique(np.array(keys, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                if not content.as_buffer().size:
                    continue
                shard = Shard(content.as_buffer().to_pybytes())
                row, rows = shard.find(wanted)
                found = [(k, i) for k, r, n in zip(wanted.tolist(), row.tolist(), rows.tolist()) for i in range(r, r + n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.int64()), pa.array([shard.ids(i).tolist() for _, i in found], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )

    return run


def lookup(spark: SparkSession, path: str, keys: list[int], index: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids) of the given keys; keys that are not there give no row.

    ``index`` (rows of read_token_shards) names the files to open, so only
    shards that may hold a key are read.
    """
    files = [path]
    if index is not None:
        ends = index.where("doc_id is not null").groupBy("path").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        asked = F.array(*[F.lit(int(k)) for k in sorted(set(keys))])
        may = F.exists(asked, lambda k: (k >= F.col("low")) & (k <= F.col("high")))
        files = [r.path for r in ends.where(may).select("path").collect()]
        if not files:
            return spark.createDataFrame([], "doc_id long, ids array<long>")
    return _files(spark, files).mapInArrow(_lookup(keys), "doc_id long, ids array<long>")
