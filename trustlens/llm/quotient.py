"""Counting quotient filters over packed word-id n-grams.

An n-gram is n 64-bit word ids, n lanes.  An invertible permutation of all
n x 64 bits makes the first lane look random; its leading bits name the shard
and then the quotient, and everything else - the rest of the first lane and all
other lanes - is stored as the remainder.  Nothing is cut off, so the filter
holds its keys exactly: quotient and remainder give the permuted key, and the
inverse permutation the n-gram.

Layout, as in a rank-and-select quotient filter: a bit per quotient that has
entries, a bit per entry that ends its quotient's run, the remainders in order,
and counters of one byte, with larger ones in a list behind them.  Entries are
sorted by permuted key, so filters are merged like sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np

from .textscan import mix

U64 = np.uint64
#: Odd multipliers of the permutation's lanes.
_LANE = 0x9E3779B97F4A7C15
_M1, _M2 = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_I1, _I2 = U64(pow(_M1, -1, 1 << 64)), U64(pow(_M2, -1, 1 << 64))
_ESCAPE = 255


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``textscan.mix``."""
    x = x ^ (x >> U64(32))
    x *= _I2
    x ^= (x >> U64(29)) ^ (x >> U64(58))
    x *= _I1
    x ^= x >> U64(32)
    return x


def _pull(lane: np.ndarray, i: int) -> np.ndarray:
    return mix(lane * U64(_LANE * (2 * i + 1) % (1 << 64)) + U64(i % (1 << 64)))


def permute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """An invertible scrambling of n lanes of 64 bits."""
    head = lanes[0]
    for i, lane in enumerate(lanes[1:], 1):
        head = mix(head ^ _pull(lane, i))
    head = mix(head)
    return [head, *(lane ^ _pull(head, -i) for i, lane in enumerate(lanes[1:], 1))]


def restore(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """The lanes that ``permute`` was given."""
    rest = [lane ^ _pull(lanes[0], -i) for i, lane in enumerate(lanes[1:], 1)]
    head = unmix(lanes[0])
    for i in range(len(rest), 0, -1):
        head = unmix(head) ^ _pull(rest[i - 1], i)
    return [head, *rest]


def count_keys(lanes: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct keys in order, sum of counts of each); without counts every
    key counts once."""
    n = len(lanes[0])
    if not n:
        return lanes, np.zeros(0, np.int64)
    order = np.argsort(lanes[0], kind="stable")
    have = [lane[order] for lane in lanes]
    same = have[0][1:] == have[0][:-1]
    other = np.zeros(n - 1, bool)
    for lane in have[1:]:
        other |= lane[1:] != lane[:-1]
    if (same & other).any():  # different keys of one first lane: order by all
        order = np.lexsort(lanes[::-1])
        have = [lane[order] for lane in lanes]
        same = have[0][1:] == have[0][:-1]
        for lane in have[1:]:
            same &= lane[1:] == lane[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    if counts is None:
        total = np.diff(np.append(first, n))
    else:
        total = np.add.reduceat(counts[order], first)
    return [lane[first] for lane in have], total.astype(np.int64)


def _width(bits: int) -> int:
    return -(-bits // 8)


def pack(lanes: list[np.ndarray], counts: np.ndarray, shard_bits: int) -> bytes:
    """The filter of one shard: permuted keys, distinct and in order, that
    agree in their first ``shard_bits`` bits."""
    n = len(counts)
    q = max(1, min(64 - shard_bits, (n - 1).bit_length()))
    r = 64 - shard_bits - q
    tail = lanes[0] & U64((1 << (64 - shard_bits)) - 1)
    quotient = (tail >> U64(r)).astype(np.int64) if r else tail.astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)
    low = (tail & U64((1 << r) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, : _width(r)]
    large = np.flatnonzero(counts >= _ESCAPE)
    shard = int(lanes[0][0]) >> (64 - shard_bits) if shard_bits else 0
    head = struct.pack("<IQQBBB", n, len(large), shard, len(lanes), shard_bits, q)
    parts = [head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), low.tobytes()]
    parts += [lane.astype("<u8").tobytes() for lane in lanes[1:]]
    parts += [np.minimum(counts, _ESCAPE).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()]
    return b"".join(parts)


def unpack(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """(permuted keys in order, counts) of a packed filter."""
    n, n_large, shard, n_lanes, shard_bits, q = struct.unpack_from("<IQQBBB", blob)
    at = struct.calcsize("<IQQBBB")
    r = 64 - shard_bits - q

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(blob, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(_width(1 << q)), count=1 << q))
    ends = np.unpackbits(take(_width(n)), count=n).astype(np.int64)
    run = np.cumsum(ends) - ends
    low = np.zeros((n, 8), np.uint8)
    low[:, : _width(r)] = take(n * _width(r)).reshape(n, _width(r))
    head = low.view("<u8").ravel() | (occupied[run].astype(np.uint64) << U64(r))
    if shard_bits:
        head |= U64(shard << (64 - shard_bits))
    lanes = [head, *(take(8 * n).view("<u8") for _ in range(n_lanes - 1))]
    counts = take(n).astype(np.int64)
    counts[counts == _ESCAPE] = take(8 * n_large).view("<i8")
    return [lane.astype(np.uint64) for lane in lanes], counts


def merge(blobs: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and counts of filters of one shard, added up.

    The filters are sorted, so the stable sort of what they hold is a merge of
    their runs."""
    opened = [unpack(b) for b in blobs]
    lanes = [np.concatenate(x) for x in zip(*(keys for keys, _ in opened))]
    return count_keys(lanes, np.concatenate([c for _, c in opened]))


def split(lanes: list[np.ndarray], counts: np.ndarray, shard_bits: int):
    """(shard, filter) of every shard that sorted permuted keys fall into."""
    if not len(counts):
        return
    shard = lanes[0] >> U64(64 - shard_bits) if shard_bits else np.zeros(len(counts), np.uint64)
    at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    for a, b in zip(at, np.append(at[1:], len(counts))):
        yield int(shard[a]), pack([lane[a:b] for lane in lanes], counts[a:b], shard_bits)
