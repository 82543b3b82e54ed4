"""A subset of the registered queries against their DuckDB oracles (sf0.001)."""
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ebbline import catalog

SF = "/root/testdata/sf0.001"
NAMES = ["churn_labels", "churn_labels_orders", "feature_matrix", "feature_matrix_nocutoff", "user_summary",
         "daily_stats", "dow_stats", "histogram_song_length", "top_songs", "session_summary", "classification_report",
         "cumulative_confusion", "ks_numeric", "psi_monitor", "psi_retrain", "psi_categorical", "score_users",
         "engineered_drift_scores", "expanding_folds", "standard_scale", "performance_trend", "incremental_stream", "state_one_hot", "standard_scaled",
         "align_to_contract", "expanding_folds_payload", "scan_event_log_rows", "monitor_log_retention", "rate_stream_events"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ["customer", "orders", "events", "documents", "labels", "nation"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = {"train_and_compare", "best_model", "feature_importance", "error_analysis_trained",
                 "temporal_validation", "monitoring_cycle", "retrain_check", "score_stream",
                 "score_with_latest_model"}
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == rows_only
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "churn_type" in df.columns
