"""Projection, cleaning and filters."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import add_days, timestamp_from_millis
from .cumulative import exact_timestamp_quantile


# P1 ----------------------------------------------------------------------------
def parse_epoch_ms(df: DataFrame, cols=("ts", "registration")) -> DataFrame:
    """Epoch-millisecond columns -> timestamps (only the ones that are integral)."""
    out = df
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.IntegralType):
            out = out.withColumn(c, timestamp_from_millis(c))
    return out


# P2 ----------------------------------------------------------------------------
def fill_unknown(df: DataFrame) -> DataFrame:
    """Nulls of the categorical columns that exist -> 'Unknown'."""
    present = [c for c in S.CATEGORICAL_FILL_COLUMNS if c in df.columns]
    return df.fillna(S.UNKNOWN, subset=present) if present else df


# P3 ----------------------------------------------------------------------------
def normalise_user_id(df: DataFrame, null_text: str = "nan") -> DataFrame:
    """userId as text; blank ids stay (a blank id is a user), null -> literal text."""
    return df.withColumn("userId", F.coalesce(F.col("userId").cast("string"), F.lit(null_text)))


# P4 ----------------------------------------------------------------------------
def preprocess_events(df: DataFrame) -> DataFrame:
    """P1 -> P2 -> P3.  No global sort: every order-dependent operator below
    carries its own (ts, event_id) ordering."""
    return normalise_user_id(fill_unknown(parse_epoch_ms(df)))


# F1 ----------------------------------------------------------------------------
def temporal_cutoff(df: DataFrame, cutoff=None) -> DataFrame:
    """Keep ``ts <= cutoff`` (inclusive; a date means its midnight)."""
    if cutoff is None:
        return df
    out = df.filter(F.col("ts") <= F.lit(cutoff).cast("timestamp"))
    if "event_date" in df.columns:   # partition pruning on the canonical table
        out = out.filter(F.col("event_date") <= F.to_date(F.lit(cutoff).cast("timestamp")))
    return out


# F2 ----------------------------------------------------------------------------
def incremental_events(df: DataFrame, last_data_ts=None, lookback_days: int = 7) -> DataFrame:
    """Events after the last training data; without one, the last 7 days (strict)."""
    if last_data_ts is not None:
        out = df.filter(F.col("ts") > F.lit(last_data_ts).cast("timestamp"))
        if "event_date" in df.columns:   # partition pruning on the canonical table
            # partitions hold event_date <= to_date(ts) (a day or a month start)
            out = out.filter(F.col("event_date") >= F.trunc(F.to_date(F.lit(last_data_ts).cast("timestamp")), "month"))
        return out
    end = df.agg(F.max("ts")).scalar()          # scalar subquery, evaluated once
    return df.filter(F.col("ts") > add_days(end, -lookback_days))


# F3 ----------------------------------------------------------------------------
def split_boundary(df: DataFrame, last_data_ts=None, quantile: float = 0.7) -> F.Column:
    """The reference/current boundary as a literal timestamp Column, computed once.

    Without ``last_data_ts`` it is the exact quantile of the event times (see
    ``cumulative.exact_timestamp_quantile``; null without events).
    """
    if last_data_ts is not None:
        return F.lit(last_data_ts).cast("timestamp")
    q = exact_timestamp_quantile(df, "ts", quantile)
    return F.timestamp_micros(F.lit(None if q is None else math.floor(q)).cast("long"))


def reference_current_split(df: DataFrame, last_data_ts=None, quantile: float = 0.7) -> DataFrame:
    """Tag each event with ``side`` = 'reference' (ts <= b) or 'current' (ts > b)."""
    b = split_boundary(df, last_data_ts, quantile)
    return df.withColumn("side", F.when(F.col("ts") <= b, "reference").otherwise("current"))


# F4 ----------------------------------------------------------------------------
def contains_downgrade(page="page") -> F.Column:
    return F.coalesce(F.col(page).contains("Downgrade"), F.lit(False))


def is_explicit_page(page="page") -> F.Column:
    return F.col(page).isin(S.EXPLICIT_CHURN_PAGES)


# F5 ----------------------------------------------------------------------------
def complete_songs(df: DataFrame) -> DataFrame:
    return df.filter(F.col("page") == "NextSong").dropna(subset=["artist", "song", "length"])


# F6 ----------------------------------------------------------------------------
def feature_projection(df: DataFrame, extra_exclude=()) -> DataFrame:
    """Model columns: everything but ids/labels; null -> 0; label as int."""
    excl = set(S.NON_FEATURE_COLUMNS) | set(extra_exclude)
    feats = [c for c in df.columns if c not in excl]
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats]
    if "is_churned" in df.columns:
        cols.append(F.col("is_churned").cast("int").alias("is_churned"))
    return df.select(*(["userId"] if "userId" in df.columns else []), *cols)


# F7 ----------------------------------------------------------------------------
def align_to_contract(df: DataFrame, feature_list, keep=("userId",)) -> DataFrame:
    """Absent expected features -> 0.0, extras dropped, fixed order."""
    have = set(df.columns)
    cols = [c for c in keep if c in have]
    cols += [(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in have else F.lit(0.0)).alias(f)
             for f in feature_list]
    return df.select(*cols)


# F8 ----------------------------------------------------------------------------
def numeric_feature_select(ref: DataFrame, cur: DataFrame, k: int = 10, exclude=("userId",)) -> list[str]:
    """First ``k`` numeric columns of ``ref`` (schema order) that ``cur`` also has."""
    cur_cols = set(cur.columns)
    out = [f.name for f in ref.schema.fields
           if isinstance(f.dataType, T.NumericType) and f.name not in exclude and f.name in cur_cols]
    return out[:k]


# U4 ----------------------------------------------------------------------------
def common_columns(a: DataFrame, b: DataFrame, exclude=()) -> list[str]:
    """Columns present in both frames, sorted (deterministic, unlike a set)."""
    return sorted((set(a.columns) & set(b.columns)) - set(exclude))


# F9 ----------------------------------------------------------------------------
def drop_unlabelled(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["is_churned"])


# F10 ---------------------------------------------------------------------------
SCORING_REQUIRED = [("userId", "string")] + [(c, "double") for c in S.NUMERIC_FEATURES[:6]]


def contract_check(df: DataFrame, required=None) -> DataFrame:
    """Per row: array of required fields that are missing (null) or absent."""
    required = required or SCORING_REQUIRED
    have = set(df.columns)
    checks = [F.when(F.col(c).isNull(), F.lit(c)) if c in have else F.lit(c) for c, _ in required]
    missing = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("missing_fields", missing).withColumn("valid", F.size("missing_fields") == 0)
