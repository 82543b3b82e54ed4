"""Membership tests by a bit table of fixed size: no false negatives, few false positives.

The table is a frame of 64-bit words.  It has at most ``words`` rows, whatever
the data, so it may be broadcast; a caller must give the right result for the
rows that it lets through by mistake.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 17     # 8.4 million bits; about 3 MB as a broadcast relation


def _word(h: Column, words: int) -> Column:
    return F.pmod(h, F.lit(words))


def _bit(h: Column) -> Column:
    return F.shiftrightunsigned(h, 58)


def bit_table(hashes: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """(_word, _bits) of a column of 64-bit hashes."""
    h = F.col(column)
    one = hashes.select(_word(h, words).alias("_word"), _bit(h).cast("int").alias("_bit"))
    return one.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def maybe_in(df: DataFrame, table: DataFrame, column: str, out: str, words: int = WORDS) -> DataFrame:
    """``df`` with ``out``: false only where the hash in ``column`` is certainly not among those of the table."""
    h = F.col(column)
    j = df.withColumn("_word", _word(h, words)).join(F.broadcast(table), "_word", "left")
    hit = F.coalesce(F.getbit("_bits", _bit(h)) == 1, F.lit(False))
    return j.withColumn(out, hit).drop("_word", "_bits")
