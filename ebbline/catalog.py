"""Registered queries: one per SURVEY §2 operator, each with its DuckDB oracle.

Every query reads the provided tables (through an adapter) at full size.
Doubles are rounded to 6 places on both sides so that float summation order
cannot flip the comparison; rounding happens only at this output boundary.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle import days, minutes, rounded, with_ev  # noqa: F401
from .sources.adapters import load_activity_events, load_order_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters that go with adapter A / B (FIXTURES.md)
CUTOFF_A = "2024-01-21 00:00:00"
INACTIVITY_A = 1
INACTIVITY_B = 365


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.round(F.col(f.name), 9), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ev_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_activity_events(spark, sf_dir)


def ev_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_order_events(spark, sf_dir)


# Load all query modules (they register on import)
from .queries import q_labels, q_features, q_explore, q_metrics, q_ml  # noqa: E402,F401
