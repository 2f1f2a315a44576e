"""Vectorised word scanning of Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  Texts are
scanned as the contiguous UTF-8 bytes of an Arrow column, so no Python string
is made per word; words become 64-bit hashes and runs of words become hashes
of hashes.  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2 = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)
_LEN = U64(0xE7037ED1A0B428DB)
#: Odd multipliers of the two independent run hashes.
RUN_A, RUN_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(32))
    x *= _M1
    x ^= x >> U64(29)
    x *= _M2
    x ^= x >> U64(32)
    return x


@dataclass
class Words:
    """Words of a column of texts, in order.  Text ``i`` has the words
    ``first[i]:first[i + 1]``; word ``j`` is ``data[start[j]:start[j] + length[j]]``."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word, eight bytes at a step."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        out = self.length.astype(np.uint64) * _LEN
        at, left, rows = self.start, self.length, None
        while len(at):
            block = eight[at] & _TAIL[np.minimum(left, 8)]
            if rows is None:
                out = mix(out ^ block)
                rows = np.flatnonzero(left > 8)
                at, left = at[rows] + 8, left[rows] - 8
            else:
                out[rows] = mix(out[rows] * U64(RUN_B) ^ block)
                more = left > 8
                rows, at, left = rows[more], at[more] + 8, left[more] - 8
        return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off.astype(np.int64) - int(off[0])


def scan(column: pa.Array, lower: bool = False) -> Words:
    """Find the words of every text; ``lower`` folds A-Z first."""
    data, off = text_bytes(column)
    if lower:
        data = data + ((data - np.uint8(65) < 26) * np.uint8(32))
    return scan_bytes(data, off)


def scan_bytes(data: np.ndarray, off: np.ndarray) -> Words:
    """Words of the texts ``data[off[i]:off[i + 1]]``."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = (data != 32) & (data - np.uint8(9) > 4)
    edge = off[(off > 0) & (off < n)]
    start, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    start[edge] |= inside[1:-1][edge]
    end[edge - 1] |= inside[1:-1][edge - 1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, start, end - start, np.searchsorted(start, off))


def run_hashes(words: np.ndarray, k: int, multiplier: int = RUN_A) -> np.ndarray:
    """Hash of the ``k`` values from each position on (positions that have so
    many), by doubling: the hash of 2m values comes from two hashes of m."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, have, power, width = None, words, multiplier, 1
    taken, bits = 0, k
    while bits:
        if bits & 1:
            part = have[taken : taken + n]
            done = part.copy() if done is None else done * U64(power) + part
            taken += width
        bits >>= 1
        if bits:
            have = have[:-width] * U64(power) + have[width:]
            power = power * power % (1 << 64)
            width *= 2
    return mix(done)


def run_starts(first: np.ndarray, k: int, total: int) -> np.ndarray:
    """Mask over the ``total - k + 1`` positions: the run stays inside its text."""
    n = max(0, total - k + 1)
    ok = np.ones(n + k + 1, bool)
    for back in range(1, k):
        at = first[1:-1] - back
        ok[at[at >= 0]] = False
    return ok[:n]


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over each window of ``width`` values."""
    have, span = values, 1
    while span * 2 <= width:
        have = best(have[:-span], have[span:])
        span *= 2
    return have if span == width else best(have[: len(values) - width + 1], have[width - span :])
