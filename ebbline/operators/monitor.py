"""Performance history (D14), retention (S4/K5) and retraining decisions."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import add_days, days_between_floor
from .evaluate import log_performance

TREND_METRICS = ["accuracy", "precision", "recall"]


def performance_log_by_period(scored: DataFrame, period_col: str, label: str = "label",
                              prob: str = "score") -> DataFrame:
    """One D13 entry per period (e.g. per day): a performance log built from data."""
    y = F.col(label).cast("int")
    pred = (F.col(prob) > 0.5).cast("int")
    c = scored.groupBy(F.col(period_col).alias("timestamp")).agg(
        F.count(F.lit(1)).alias("num_predictions"), F.sum((y == pred).cast("int")).alias("_correct"),
        F.sum(y * pred).alias("_tp"), F.sum(pred).alias("_pp"), F.sum(y).alias("_ap"),
        F.avg(F.col(prob)).alias("avg_churn_probability"))
    n = F.col("num_predictions")
    prec = F.col("_tp") / F.greatest(F.col("_pp"), F.lit(1))
    rec = F.col("_tp") / F.greatest(F.col("_ap"), F.lit(1))
    return c.select("timestamp", "num_predictions", (F.col("_correct") / n).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    (2 * prec * rec / F.greatest(prec + rec, F.lit(1e-8))).alias("f1_score"),
                    (F.col("_ap") / n).alias("churn_rate"), (F.col("_pp") / n).alias("prediction_rate"),
                    "avg_churn_probability")




# D14 ---------------------------------------------------------------------------
def performance_trend(log: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Over entries newer than ``as_of - days`` (default: the log's latest
    entry): count, mean, population std and least-squares slope against the
    entry index for accuracy, precision and recall.  Long form per metric.

    The log holds one row per evaluation run, so its ordered window is small
    by nature.
    """
    end = F.lit(as_of).cast("timestamp") if as_of is not None else log.agg(F.max("timestamp")).scalar()
    recent = log.filter(F.col("timestamp") > add_days(end, -days))
    idx = recent.withColumn("idx", (F.row_number().over(W.orderBy("timestamp")) - 1).cast("double"))
    long = idx.unpivot(["idx"], TREND_METRICS, "metric", "v")
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("num_evaluations"), F.avg("v").alias("mean"),
                                      F.stddev_pop("v").alias("std"), F.regr_slope("v", "idx").alias("trend"))


# S4 / K5 -------------------------------------------------------------------------
def last_k_entries(log: DataFrame, k: int, ts: str = "timestamp") -> DataFrame:
    """Retention on read: the newest ``k`` entries (a top-k, not a sample)."""
    return log.orderBy(F.col(ts).desc()).limit(k)


# R1 ----------------------------------------------------------------------------
def retrain_triggers(inputs: DataFrame, schedule_days: int = 7, performance_threshold: float = 0.1,
                     drift_threshold: float = 0.1, min_new_data_size: int = 100) -> DataFrame:
    """Decision row from one input row with columns: now, last_training_time
    (null: no model), baseline_metric, current_metric, max_drift_score,
    new_events, new_users.

    retrain = (schedule or performance or drift) and volume.
    """
    days = days_between_floor("now", "last_training_time")
    no_model = F.col("last_training_time").isNull()
    schedule = no_model | (days >= schedule_days)
    drop = F.col("baseline_metric") - F.col("current_metric")
    perf = F.coalesce(drop > performance_threshold, F.lit(False))
    drift = F.coalesce(F.col("max_drift_score") > drift_threshold, F.lit(False))
    volume = F.col("new_events") >= min_new_data_size
    reasons = F.array_compact(F.array(
        F.when(no_model, F.lit("First training - no model exists")),
        F.when(~no_model & schedule, F.concat(F.lit("Scheduled retraining ("), days.cast("string"), F.lit(" days)"))),
        F.when(perf, F.concat(F.lit("Performance drop: "), F.format_number(drop, 3))),
        F.when(drift, F.lit("Data drift detected via PSI")),
        F.when(volume, F.concat(F.lit("Sufficient new data: "), F.col("new_events").cast("string"), F.lit(" events")))
         .otherwise(F.concat(F.lit("Insufficient data: "), F.col("new_events").cast("string"), F.lit(" < "),
                             F.lit(str(min_new_data_size))))))
    return inputs.select(schedule.alias("schedule_trigger"), perf.alias("performance_trigger"),
                         drift.alias("drift_trigger"), volume.alias("data_volume_trigger"),
                         ((schedule | perf | drift) & volume).alias("should_retrain"), reasons.alias("reasons"),
                         "new_events", "new_users")


# R2 ----------------------------------------------------------------------------
def deployment_gate(candidates: DataFrame, improvement_threshold: float = 0.02) -> DataFrame:
    """Deploy if there is no baseline or new - baseline >= threshold."""
    imp = F.col("new_metric") - F.col("baseline_metric")
    return candidates.select("*", F.coalesce(imp, F.lit(0.0)).alias("performance_improvement"),
                             (F.col("baseline_metric").isNull() | (imp >= improvement_threshold))
                             .alias("should_deploy"))
