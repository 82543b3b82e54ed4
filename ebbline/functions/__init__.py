"""Scalar expression helpers (G1-G14).  All return JVM-side Columns."""
from .exprs import (  # noqa: F401
    DAY_US, MINUTE_US, add_days, bin_range, days_between, days_between_floor, equal_width_bin, extract_state_nb,
    first_value_struct, greatest1, last_value_struct, location_state, minutes_between, order_key,
    risk_level, safe_ratio, sigmoid, timestamp_from_millis, weekday_name,
)
