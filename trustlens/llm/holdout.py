"""What the trained classifiers share: the split and the letter scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .textscan import text_bytes


def held_out(doc_id: Column) -> Column:
    """True for rows that are never learned from: crc32 of the id as text
    divisible by 5, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts with A-Z folded and every other ASCII
    byte that is no letter replaced by a space."""
    data, off = text_bytes(column)
    low = data | np.uint8(32)
    return np.where(low - np.uint8(97) < 26, low, np.where(data > 127, data, np.uint8(32))), off


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)
