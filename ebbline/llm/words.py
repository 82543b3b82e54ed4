"""Words of whole texts by their bytes, for operators that hold a block of documents as arrays.

All separators are single ASCII bytes, which never occur inside a longer UTF-8
character, so texts are split on their bytes.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes

BITMAP = 32768           # bits of one row of Spark's bitmap aggregate


def byte_kinds(separators: bytes, breaks: bytes = b"") -> np.ndarray:
    """0 for a byte of a word, 1 for one between words, 2 for one that also ends a piece."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(separators)] = 1
    kinds[list(breaks)] = 2
    return kinds


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32       # A-Z only


def words_of(column: pa.Array, kinds: np.ndarray, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of a string column in order; of each its row, and whether it begins a piece."""
    data, offs = raw_bytes(column)
    offs = offs.astype(np.int64)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, bool)
    kind = kinds[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offs[:-1][np.diff(offs) > 0]
    first[starts] |= inside[starts]
    at = np.flatnonzero(first)
    body = data[inside]
    if lower:
        body = LOWER[body]
    ends = np.r_[np.cumsum(inside)[at] - 1, len(body)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body))])
    row = np.searchsorted(offs, at, side="right") - 1
    marks = kind == 2
    marks[starts] = True
    piece = np.cumsum(marks)[at]
    return words, row, np.r_[True, piece[1:] != piece[:-1]][:len(at)]


def bit_table(cells: DataFrame, column: str, size: int) -> np.ndarray:
    """Which of ``size`` cells occur, as ``size / 8`` bytes; the bits are set by Spark and only they are collected."""
    value = F.col(column).cast("long") + 1
    rows = (cells.groupBy(F.bitmap_bucket_number(value).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")).collect())
    out = np.zeros(-(-size // BITMAP) * BITMAP // 8, np.uint8)
    for r in rows:
        at = (r["b"] - 1) * BITMAP // 8
        out[at:at + BITMAP // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def bits_at(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (table[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def digest_of_text() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
