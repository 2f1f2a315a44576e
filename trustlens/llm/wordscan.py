"""Word scanning by byte classes.

``textscan`` knows one kind of word; here the caller says which bytes are part
of a word, which part words, and which part pieces (runs of words that belong
together).  Bytes of a UTF-8 sequence beyond ASCII have values from 0x80 on, so
a class may hold all of them or none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .textscan import Words, text_bytes

WORD, GAP, BREAK = 0, 1, 2


def byte_classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of each byte value: ``gaps`` part words, ``breaks`` part pieces
    (and words), all others make words."""
    table = np.zeros(256, np.uint8)
    table[np.frombuffer(gaps, np.uint8)] = GAP
    table[np.frombuffer(breaks, np.uint8)] = BREAK
    return table


@dataclass
class Pieces:
    """Words of a column of texts, and what they belong to."""

    words: Words
    row: np.ndarray  # text of each word
    piece: np.ndarray  # equal for two words of a text iff no break is between them

    def together(self, k: int) -> np.ndarray:
        """Positions from which ``k`` words on are in one piece."""
        n = max(0, len(self.row) - k + 1)
        a, b = slice(0, n), slice(k - 1, k - 1 + n)
        return np.flatnonzero((self.row[a] == self.row[b]) & (self.piece[a] == self.piece[b]))


def scan_pieces(column: pa.Array, table: np.ndarray) -> Pieces:
    """Words of every text, with A-Z folded to lower case; null is empty."""
    data, off = text_bytes(column)
    data = data + ((data - np.uint8(65) < 26) * np.uint8(32))
    kind = table[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind == WORD
    edge = off[(off > 0) & (off < len(data))]
    start, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    start[edge] |= inside[1:-1][edge]
    end[edge - 1] |= inside[1:-1][edge - 1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(start, off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Pieces(Words(data, start, end - start, first), row, np.cumsum(kind == BREAK)[start])
