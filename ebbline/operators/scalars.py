"""Attaching one-row results as scalar subqueries (no join operator).

Global values - the dataset end, a split quantile, class totals, a bin
range - are one-row aggregates.  They are attached to rows as an
uncorrelated scalar subquery: Spark evaluates it once and inlines the value,
so no join (and no pairing of rows) appears in the plan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scalar_struct(one_row: DataFrame):
    """The single row of ``one_row`` as one struct-valued scalar Column."""
    return one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus the columns of a one-row frame (evaluated once)."""
    s = scalar_struct(one_row)
    return df.withColumn("_s", s).select(*[F.col(f"`{c}`") for c in df.columns],
                                         *[F.col("_s").getField(c).alias(c) for c in one_row.columns])


def combine_rows(*rows: DataFrame) -> DataFrame:
    """Side-by-side concatenation of one-row frames into one row."""
    out = rows[0]
    for r in rows[1:]:
        out = attach_scalars(out, r)
    return out
