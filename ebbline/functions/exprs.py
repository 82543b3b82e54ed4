"""Scalar helpers G1-G14 as built-in Column expressions (no Python UDFs).

Every event-order notion uses the explicit key ``(ts, event_id)``: Spark rows
have no order, so "first"/"last" are min/max of a struct led by that key.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
MINUTE_US = 60_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# G1 --------------------------------------------------------------------------
def timestamp_from_millis(col) -> Column:
    """Epoch milliseconds -> timestamp (UTC)."""
    return F.timestamp_millis(_c(col))


# G2 --------------------------------------------------------------------------
def days_between_floor(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later``, floored (a timedelta's ``.days``).

    Not ``datediff`` (calendar days) and not ``timestampdiff`` (truncates
    towards zero).  Null if either side is null.
    """
    diff = F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))
    return F.floor(diff / F.lit(float(DAY_US))).cast("long")


days_between = days_between_floor


# G3 --------------------------------------------------------------------------
def minutes_between(start, end) -> Column:
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(float(MINUTE_US))


# G4 --------------------------------------------------------------------------
def add_days(ts, n: int) -> Column:
    """``ts + n days`` as an exact 24h multiple (UTC session)."""
    return F.timestamp_micros(F.unix_micros(_c(ts)) + F.lit(int(n) * DAY_US))


# G5 --------------------------------------------------------------------------
def weekday_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


# G6 / G7 ----------------------------------------------------------------------
def location_state(location) -> Column:
    """Feature variant: last comma part, trimmed, only with two or more parts."""
    parts = F.split(_c(location), ",")
    return F.when(F.size(parts) >= 2, F.trim(F.element_at(parts, -1)))


def extract_state_nb(location) -> Column:
    """Notebook variant: split on ', ', else 'Unknown' (also for null / 'Unknown')."""
    parts = F.split(_c(location), ", ")
    return (F.when(_c(location).isNull() | (_c(location) == "Unknown"), F.lit("Unknown"))
            .when(F.size(parts) > 1, F.element_at(parts, -1))
            .otherwise(F.lit("Unknown")))


# G8 --------------------------------------------------------------------------
def greatest1(x) -> Column:
    return F.greatest(_c(x), F.lit(1))


def safe_ratio(num, den, zero=0.0) -> Column:
    """num/den with den == 0 or null -> ``zero`` (keeps doubles NaN-free)."""
    den = _c(den)
    return F.when(den.isNull() | (den == 0), F.lit(zero)).otherwise(_c(num) / den)


# G9 --------------------------------------------------------------------------
def bin_range(lo, hi):
    """Histogram range of a sample: (min, max), widened by 0.5 each side if equal."""
    lo, hi = _c(lo), _c(hi)
    same = lo == hi
    return (F.when(same, lo - F.lit(0.5)).otherwise(lo).cast("double"),
            F.when(same, hi + F.lit(0.5)).otherwise(hi).cast("double"))


def equal_width_bin(value, lo, hi, bins: int = 10) -> Column:
    """Bin index 0..bins-1 of ``value`` on ``bins`` equal-width bins over [lo, hi].

    Edges are the doubles a linspace builds: ``e_i = i*step + lo`` with
    ``step = (hi-lo)/bins`` and ``e_bins = hi``.  Bins are half-open except
    the last, which is closed; out-of-range values give null.  The index is
    a floor of the scaled value corrected once against the exact edges, so
    a value never lands across an edge through rounding.
    """
    v, lo, hi = _c(value).cast("double"), _c(lo), _c(hi)
    step = (hi - lo) / F.lit(float(bins))
    top = bins - 1

    def edge(i):
        return F.when(i >= bins, hi).otherwise(i.cast("double") * step + lo)

    i0 = F.least(F.greatest(F.floor((v - lo) / step), F.lit(0)), F.lit(top)).cast("int")
    i1 = (F.when(v < edge(i0), i0 - 1).when(v >= edge(i0 + 1), i0 + 1).otherwise(i0))
    i1 = F.least(F.greatest(i1, F.lit(0)), F.lit(top))
    return F.when((v >= lo) & (v <= hi), i1)


# G10 -------------------------------------------------------------------------
def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


# G11 -------------------------------------------------------------------------
def risk_level(p) -> Column:
    p = _c(p)
    return F.when(p >= 0.8, "high").when(p >= 0.5, "medium").otherwise("low")


# Ordering helpers -------------------------------------------------------------
def order_key(ts="ts", tie="event_id") -> Column:
    return F.struct(_c(ts).alias("o_ts"), _c(tie).alias("o_id"))


def first_value_struct(cond, *cols, ts="ts", tie="event_id") -> Column:
    """Aggregate: the earliest row (by ts, event_id) among rows where ``cond``.

    Returns a struct; read fields with ``["name"]``.  Partial-aggregatable,
    so a hot key costs no single-task gather.
    """
    payload = F.struct(_c(ts).alias("o_ts"), _c(tie).alias("o_id"), *[_c(c) for c in cols])
    return F.min(payload if cond is None else F.when(cond, payload))


def last_value_struct(cond, *cols, ts="ts", tie="event_id") -> Column:
    payload = F.struct(_c(ts).alias("o_ts"), _c(tie).alias("o_id"), *[_c(c) for c in cols])
    return F.max(payload if cond is None else F.when(cond, payload))
