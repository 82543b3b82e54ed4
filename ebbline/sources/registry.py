"""Model registry and append-only logs (S2-S8) as tables.

Every log is an append-only parquet table; "keep the last N" is retention
on read (a top-k), never a rewrite.  ``compact`` gathers a log's small files in a version beside it.  Nested payloads (triggers, results)
are stored as JSON strings via ``to_json``.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from .canonical import path_exists

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_path", T.StringType()),
    T.StructField("best_model_type", T.StringType()),
    T.StructField("last_training_time", T.TimestampType()),
    T.StructField("last_data_ts", T.TimestampType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("feature_list", T.ArrayType(T.StringType())),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("is_deployed", T.BooleanType()),
])
PERF_LOG_SCHEMA = ("timestamp timestamp, num_predictions long, accuracy double, precision double, recall double, "
                   "f1_score double, churn_rate double, prediction_rate double, avg_churn_probability double")
MONITOR_LOG_SCHEMA = ("timestamp timestamp, monitoring_id string, drift_detected boolean, max_drift_score double, "
                      "performance_degradation boolean, event_rate_change double")
RETRAIN_LOG_SCHEMA = "timestamp timestamp, event_type string, details string"


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a log table; an absent one is empty, and so is each corrupt file
    (the reader skips it when the rows are read, not only when it is opened)."""
    if versions.manifests(spark, path):
        return _read(spark, versions.log_paths(spark, path), schema)
    if path_exists(spark, path):
        return _read(spark, [path], schema)
    return spark.createDataFrame([], schema)


def _read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    return spark.read.option("ignoreCorruptFiles", "true").schema(schema).parquet(*paths)


def compact(spark: SparkSession, path: str, schema) -> None:
    """Gather the files of a log in one version; readers and appends go on meanwhile."""
    versions.compact_log(spark, path, lambda paths: _read(spark, paths, schema))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# S2 ----------------------------------------------------------------------------
def scan_registry(spark: SparkSession, path: str, deployed_only: bool = True) -> DataFrame:
    """Latest (deployed) registry row; empty if there is none."""
    reg = _read_or_empty(spark, path, REGISTRY_SCHEMA)
    if deployed_only:
        reg = reg.filter(F.col("is_deployed"))
    return reg.orderBy(F.col("created_at").desc()).limit(1)


# S7 ----------------------------------------------------------------------------
def save_model(model, registry_path: str, model_dir: str, metrics: dict, model_type: str,
               feature_list: list[str], last_data_ts, deploy: bool, now: dt.datetime | None = None) -> str:
    """Persist the model under a timestamped name and append a registry row;
    ``is_deployed`` marks the row that readers resolve to."""
    spark = SparkSession.getActiveSession()
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    path = f"{model_dir.rstrip('/')}/model_{now.strftime('%Y%m%d_%H%M%S')}"
    model.write().overwrite().save(path)
    row = [(path, model_type, now, last_data_ts, metrics.get("pr_auc"), metrics.get("roc_auc"),
            metrics.get("f1_score"), metrics.get("precision"), metrics.get("recall"), list(feature_list), now,
            bool(deploy))]
    append(spark.createDataFrame(row, REGISTRY_SCHEMA), registry_path)
    return path


# S8 ----------------------------------------------------------------------------
def model_rows(spark: SparkSession, registry_path: str) -> DataFrame:
    """Registry rows in the order in which readers try them: deployed first, then the newest."""
    reg = _read_or_empty(spark, registry_path, REGISTRY_SCHEMA)
    return reg.orderBy(F.col("is_deployed").desc_nulls_last(), F.col("created_at").desc())


def load_latest_model(spark: SparkSession, registry_path: str, loader):
    """Resolve and load the model (``loader`` e.g. ``LogisticRegressionModel.load``):
    the first row, in ``model_rows`` order, whose model files exist (one row per run, streamed)."""
    for r in model_rows(spark, registry_path).toLocalIterator():
        if path_exists(spark, r["model_path"]):
            return loader(r["model_path"]), r
    return None, None


# S3 ----------------------------------------------------------------------------
def sink_drift_report(report: DataFrame, path: str, run_id: str) -> None:
    report.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def latest_drift_report(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], "run_id string")
    r = spark.read.parquet(path)
    last = r.agg(F.max("run_id").alias("run_id"))
    return r.join(F.broadcast(last), "run_id")   # one row


# S4 / S5 -------------------------------------------------------------------------
def sink_monitor_log(entry: DataFrame, path: str) -> None:
    append(entry, path)


def read_monitor_log(spark: SparkSession, path: str, keep: int = 100) -> DataFrame:
    """Retention on read: the newest ``keep`` entries."""
    return _read_or_empty(spark, path, MONITOR_LOG_SCHEMA).orderBy(F.col("timestamp").desc()).limit(keep)


def sink_perf_log(entry: DataFrame, path: str) -> None:
    append(entry, path)


def read_perf_log(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, PERF_LOG_SCHEMA)


# S6 ----------------------------------------------------------------------------
def sink_retrain_log(spark: SparkSession, path: str, event_type: str, details: DataFrame,
                     now: dt.datetime | None = None) -> None:
    """Append one event; ``details`` (one row) is stored as a JSON string."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    e = details.select(F.lit(now).cast("timestamp").alias("timestamp"), F.lit(event_type).alias("event_type"),
                       F.to_json(F.struct(*details.columns)).alias("details"))
    append(e, path)


def read_retrain_log(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, RETRAIN_LOG_SCHEMA)
