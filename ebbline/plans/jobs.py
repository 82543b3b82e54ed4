"""Composed batch jobs: monitoring cycle (D15), retraining job (M16) and the
retraining check (R3).  Each reads the canonical events, writes its results
to tables and returns DataFrames; decisions read back only one-row scalars.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import drift as D
from ..operators import features as X
from ..operators import labels as L
from ..operators import monitor as M
from ..operators.prep import incremental_events, reference_current_split
from ..sources import registry as REG
from . import training as TR
from ..operators.scalars import combine_rows
from ..session import staged


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# D15 ---------------------------------------------------------------------------
def monitoring_cycle(events: DataFrame, paths: dict, last_data_ts=None, now: dt.datetime | None = None,
                     threshold: float = 0.1) -> DataFrame:
    """F3 split -> D10 engineered PSI + D12 event-rate proxy -> S3 report,
    S4 log entry.  Returns the one-row summary."""
    now = now or _now()
    run_id = now.strftime("%Y%m%d_%H%M")
    scores, report = D.engineered_drift(events, last_data_ts=last_data_ts, threshold=threshold)
    rate = D.event_rate_proxy(reference_current_split(events, last_data_ts), threshold)
    REG.sink_drift_report(scores.withColumn("threshold", F.lit(threshold)), paths["drift_reports"], run_id)
    entry = combine_rows(report, rate).select(
        F.lit(now).cast("timestamp").alias("timestamp"), F.lit(run_id).alias("monitoring_id"),
        "drift_detected", "max_drift_score", "performance_degradation", "event_rate_change")
    entry = staged(entry)          # one row; do not recompute the drift plan twice
    REG.sink_monitor_log(entry, paths["monitor_log"])
    return entry


# M16 ---------------------------------------------------------------------------
def retrain_job(new_events: DataFrame, paths: dict, inactivity_days: int = 30, models=None,
                improvement_threshold: float = 0.02, now: dt.datetime | None = None) -> DataFrame:
    """Features (no cutoff) + labels on the new data -> temporal validation ->
    train and compare -> deployment gate (R2) -> save (S7).  One-row result."""
    spark = new_events.sparkSession
    now = now or _now()
    fm = X.feature_matrix(new_events, None)
    labels = L.churn_labels(new_events, inactivity_days)
    model_df = staged(X.features_with_labels(fm, labels))
    validation = TR.temporal_validation(model_df)
    metrics, fitted, prep = TR.train_and_compare(model_df, models)
    metrics = staged(metrics)
    best = TR.best_model(metrics).first()
    baseline = REG.scan_registry(spark, paths["registry"]).select("pr_auc").collect()
    base = baseline[0]["pr_auc"] if baseline else None
    cand = spark.createDataFrame([(best["model"], float(best["pr_auc"] or 0.0), base)],
                                 "model string, new_metric double, baseline_metric double")
    gate = M.deployment_gate(cand, improvement_threshold).first()
    last_ts = new_events.agg(F.max("ts")).first()[0]
    model_path = REG.save_model(TR.as_pipeline(fitted[best["model"]], prep), paths["registry"], paths["models"],
                                best.asDict(), best["model"], prep.columns, last_ts, gate["should_deploy"], now)
    v = validation.first()
    return spark.createDataFrame(
        [(True, best["model"], float(best["pr_auc"] or 0.0), float(gate["performance_improvement"]),
          bool(gate["should_deploy"]), model_df.count(), model_path, float(v["avg_pr_auc"]),
          bool(v["leakage_warning"]))],
        "success boolean, best_model string, pr_auc double, performance_improvement double, should_deploy boolean, "
        "training_data_size long, model_file string, validation_pr_auc double, leakage_warning boolean")


# R3 ----------------------------------------------------------------------------
def retrain_check(events: DataFrame, paths: dict, current_metric: float = 0.8, now: dt.datetime | None = None,
                  run_retrain: bool = True, **retrain_kwargs) -> DataFrame:
    """F2 incremental data -> R1 triggers (with D7 drift vs the last training
    window) -> M16 if triggered -> S6 log.  Returns the trigger row."""
    spark = events.sparkSession
    now = now or _now()
    reg = REG.scan_registry(spark, paths["registry"]).collect()
    last = reg[0] if reg else None
    last_data_ts = last["last_data_ts"] if last else None
    new = incremental_events(events, last_data_ts)
    counts = new.agg(F.count(F.lit(1)).alias("new_events"), F.countDistinct("userId").alias("new_users"))
    if last_data_ts is not None:
        _, rep = D.engineered_drift(events, last_data_ts=last_data_ts, variant="retrain")
        drift = rep.select("max_drift_score")
    else:
        drift = spark.range(1).select(F.lit(None).cast("double").alias("max_drift_score"))
    inputs = combine_rows(counts, drift).select(
        F.lit(now).cast("timestamp").alias("now"),
        F.lit(last["last_training_time"] if last else None).cast("timestamp").alias("last_training_time"),
        F.lit(last["pr_auc"] if last else None).cast("double").alias("baseline_metric"),
        F.lit(current_metric).alias("current_metric"), "max_drift_score", "new_events", "new_users")
    triggers = staged(M.retrain_triggers(inputs))
    t = triggers.first()
    if t["should_retrain"] and run_retrain:
        result = retrain_job(new, paths, now=now, **retrain_kwargs)
        REG.sink_retrain_log(spark, paths["retrain_log"], "retraining_executed",
                             combine_rows(triggers, result.select("best_model", "pr_auc", "should_deploy")), now)
    else:
        REG.sink_retrain_log(spark, paths["retrain_log"], "retraining_check",
                             triggers.withColumn("action", F.lit("no_retraining_needed")), now)
    return triggers


# D1/D2 with S8, D13 with S5 -----------------------------------------------------------
def score_with_latest_model(events: DataFrame, paths: dict, cutoff=None, labels: DataFrame | None = None,
                            now: dt.datetime | None = None):
    """Resolve the deployed model (S8), score the users' features (D1),
    summarise (D2) and, when labels are given, log performance (D13 -> S5).
    Returns (scores, summary) or (None, None) without a usable model."""
    from pyspark.ml import PipelineModel
    from ..operators import evaluate as V
    from ..operators import scoring as SC
    spark = events.sparkSession
    now = now or _now()
    model, meta = REG.load_latest_model(spark, paths["registry"], PipelineModel.load)
    if model is None:
        return None, None
    feats = list(meta["feature_list"])
    fm = X.feature_matrix(events, cutoff)
    from ..operators import dataset as DS
    states = [c[len("state_"):] for c in feats if c.startswith("state_")]
    fm = DS.state_one_hot(fm, states)
    scores = staged(SC.score_users(fm, feats, model, scored_at=now))
    summary = SC.score_summary(scores)
    if labels is not None:
        perf = V.log_performance(scores.join(labels.select("userId", F.col("is_churned").cast("int").alias("label")),
                                             "userId"), "label", "churn_probability")
        REG.sink_perf_log(perf.select(F.lit(now).cast("timestamp").alias("timestamp"), "*"), paths["perf_log"])
    return scores, summary


def default_paths(base: str) -> dict:
    base = base.rstrip("/")
    return {k: f"{base}/{k}" for k in ("registry", "models", "drift_reports", "monitor_log", "perf_log",
                                        "retrain_log")}


__all__ = ["monitoring_cycle", "retrain_job", "retrain_check", "default_paths", "S"]
