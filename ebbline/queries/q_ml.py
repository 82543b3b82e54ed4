"""M1-M4, W7 (oracle-checked), M8, M13-M16, K6, D15, R3, S1-S8, T1-T3 (rows-only)."""
from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..catalog import CUTOFF_A, INACTIVITY_A, ORACLE, QUERIES, ev_a, register
from ..operators import dataset as DS
from ..operators import drift as D
from ..operators import features as X
from ..operators import labels as L
from ..operators.prep import align_to_contract, preprocess_events
from ..operators.scalars import combine_rows
from ..oracle import R, with_ev
from ..plans import jobs as J
from ..plans import training as TR
from ..session import shared_path, staged
from ..sources import eventlog as EL
from ..sources import registry as REG
from ..sources.adapters import activity_events_path, read_table
from ..streaming import streams as ST
from .q_features import _LAB_FOR_JOIN, feature_ctes, fm_select

N = INACTIVITY_A


def _model_df(spark, sf):
    ev = ev_a(spark, sf)
    return staged(X.features_with_labels(X.feature_matrix(ev, CUTOFF_A), L.churn_labels(ev, N)))


def _run_dir(spark, name):
    return shared_path(spark, f"runs/{name}-{uuid.uuid4().hex[:8]}")


TS_CTES = feature_ctes(CUTOFF_A) + "," + _LAB_FOR_JOIN + """,
tset AS (SELECT fm.*, (l.churn_type <> 'not_churned') AS is_churned FROM fm JOIN lab3 l USING (userId)),
tsq AS (SELECT quantile_cont(coalesce(CAST(days_since_registration AS DOUBLE), 0.0), 0.8) AS q FROM tset),
tsp AS (SELECT tset.*, CASE WHEN coalesce(CAST(days_since_registration AS DOUBLE), 0.0) <= tsq.q THEN 'train'
                            ELSE 'test' END AS split FROM tset, tsq)"""


# M1 ----------------------------------------------------------------------------
register("time_based_split", with_ev(f"""
SELECT split, count(*) AS users, count(*) FILTER (WHERE is_churned) AS churned,
       {R('avg(CAST(is_churned AS DOUBLE))')} AS churn_rate FROM tsp GROUP BY split""", "A", TS_CTES))(
    lambda spark, sf: DS.time_based_split(_model_df(spark, sf)).groupBy("split").agg(
        F.count(F.lit(1)).alias("users"), F.count_if("is_churned").alias("churned"),
        F.avg(F.col("is_churned").cast("double")).alias("churn_rate")))


# M2 ----------------------------------------------------------------------------
def _states(spark, sf):
    d = DS.time_based_split(_model_df(spark, sf))
    return DS.common_states(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test"))


_TOP = ("SELECT location_state, count(*) AS n FROM tsp WHERE split = '{s}' AND location_state IS NOT NULL "
        "GROUP BY 1 ORDER BY n DESC, location_state LIMIT 10")
register("common_states", with_ev(f"""
SELECT a.location_state, a.n AS train_count, b.n AS test_count
FROM ({_TOP.format(s='train')}) a JOIN ({_TOP.format(s='test')}) b USING (location_state)""", "A", TS_CTES))(_states)


def _one_hot(spark, sf):
    d = staged(DS.time_based_split(_model_df(spark, sf)))
    states = DS.state_list(d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test"))
    flags = DS.state_one_hot(d.select("userId", "location_state"), states)
    pairs = [F.struct(F.lit(s).alias("state"), F.col(f"state_{s}").alias("flag")) for s in states]
    each = F.array(*pairs) if pairs else F.array().cast("array<struct<state:string,flag:int>>")
    return flags.select("userId", F.explode(each).alias("p")).select("userId", "p.state", "p.flag")


register("state_one_hot", with_ev(f"""
SELECT userId, s.location_state AS state, CAST(tsp.location_state = s.location_state AS INTEGER) AS flag
FROM tsp CROSS JOIN (SELECT location_state FROM ({_TOP.format(s='train')}) a
                     JOIN ({_TOP.format(s='test')}) b USING (location_state)) s""", "A", TS_CTES))(_one_hot)

# M3 ----------------------------------------------------------------------------
register("balanced_weights", with_ev(f"""
SELECT CAST(is_churned AS INTEGER) AS label, count(*) AS n_class,
       {R('(SELECT count(*) FROM tset) / (2.0 * count(*))')} AS weight FROM tset GROUP BY 1""", "A", TS_CTES))(
    lambda spark, sf: DS.balanced_weights(_model_df(spark, sf).withColumn("label", F.col("is_churned").cast("int")),
                                          "label").groupBy("label").agg(F.count(F.lit(1)).alias("n_class"),
                                                                        F.max("weight").alias("weight")))

# M4 ----------------------------------------------------------------------------
register("standard_scale", with_ev(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {R(f'avg(coalesce(CAST({c} AS DOUBLE), 0.0))')} AS mean, "
    f"{R(f'CASE WHEN stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) = 0 THEN 1.0 ELSE stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) END')} AS std "
    f"FROM tsp WHERE split = 'train'" for c in S.NUMERIC_FEATURES), "A", TS_CTES))(
    lambda spark, sf: DS.scaler_params(DS.time_based_split(_model_df(spark, sf)).filter(F.col("split") == "train"),
                                       S.NUMERIC_FEATURES))



def _scaled(spark, sf):
    d = staged(DS.time_based_split(_model_df(spark, sf)))
    params = DS.collect_scaler(DS.scaler_params(d.filter(F.col("split") == "train"), S.NUMERIC_FEATURES))
    return DS.standard_scale(d.select("userId", "split", *S.NUMERIC_FEATURES), params)


register("standard_scaled", with_ev("SELECT userId, split, " + ", ".join(
    R(f"(coalesce(CAST({c} AS DOUBLE), 0.0) - prm.m_{i}) / CASE WHEN prm.s_{i} = 0 THEN 1.0 ELSE prm.s_{i} END") + f" AS {c}"
    for i, c in enumerate(S.NUMERIC_FEATURES)) + " FROM tsp, (SELECT " + ", ".join(
    f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{i}, stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS s_{i}"
    for i, c in enumerate(S.NUMERIC_FEATURES)) + " FROM tsp WHERE split = 'train') prm", "A", TS_CTES))(_scaled)


# F7 with an absent and an extra column --------------------------------------------------
def _aligned(spark, sf):
    absent, *rest = S.NUMERIC_FEATURES
    m = _model_df(spark, sf).select("userId", *rest, F.lit(7.0).alias("not_in_the_contract"))
    return align_to_contract(m, [absent, *rest])


register("align_to_contract", with_ev(
    f"SELECT userId, 0.0 AS {S.NUMERIC_FEATURES[0]}, "
    + ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), 0.0)')} AS {c}" for c in S.NUMERIC_FEATURES[1:]) + " FROM tset",
    "A", TS_CTES))(_aligned)

# W7 ----------------------------------------------------------------------------
register("expanding_folds_payload", with_ev(f"""
SELECT userId, idx, {R('coalesce(CAST(total_events AS DOUBLE), 0.0)')} AS total_events, location_state
FROM (SELECT *, row_number() OVER (ORDER BY coalesce(days_since_registration, 0) DESC, userId) - 1 AS idx FROM tset)""",
                                            "A", TS_CTES))(
    lambda spark, sf: DS.expanding_folds(_model_df(spark, sf)).select("userId", "idx", "total_events", "location_state"))
register("expanding_folds", with_ev("""
SELECT userId, idx, CASE WHEN idx >= n - 3 * ts AND ts > 0 THEN CAST(floor((idx - (n - 3 * ts)) / ts) AS INTEGER) END
         AS test_fold
FROM (SELECT userId, row_number() OVER (ORDER BY coalesce(days_since_registration, 0) DESC, userId) - 1 AS idx,
             count(*) OVER () AS n, floor(count(*) OVER () / 4) AS ts FROM tset)""", "A", TS_CTES))(
    lambda spark, sf: DS.expanding_folds(_model_df(spark, sf)).select("userId", "idx", "test_fold"))


# M13 / K6 / M8 / M14 (rows-only: fitted models) ---------------------------------------
def _train(spark, sf):
    metrics, fitted, prep = TR.train_and_compare(_model_df(spark, sf))
    return metrics


register("train_and_compare")(_train)
register("best_model")(lambda spark, sf: TR.best_model(_train(spark, sf)))


def _importance(spark, sf):
    _, fitted, prep = TR.train_and_compare(_model_df(spark, sf))
    parts = [TR.feature_importance(spark, m, prep.columns).withColumn("model", F.lit(name)) for name, m in fitted.items()]
    return functools.reduce(DataFrame.unionByName, parts)


register("feature_importance")(_importance)


def _err_trained(spark, sf):
    metrics, fitted, prep = TR.train_and_compare(_model_df(spark, sf))
    best = TR.best_model(metrics).first()["model"]
    return TR.error_analysis_for(fitted[best], prep, prep.scored[best])


register("error_analysis_trained")(_err_trained)
register("temporal_validation")(lambda spark, sf: TR.temporal_validation(_model_df(spark, sf)))


# D15 / R3 / M16 / S2-S8 ---------------------------------------------------------------
def _monitoring(spark, sf):
    paths = J.default_paths(_run_dir(spark, "monitoring"))
    return J.monitoring_cycle(ev_a(spark, sf), paths)


def _retrain_check(spark, sf):
    paths = J.default_paths(_run_dir(spark, "retrain"))
    J.retrain_check(ev_a(spark, sf), paths)            # first run: no model -> retrain, save, log
    return combine_rows(REG.read_retrain_log(spark, paths["retrain_log"]),
                        REG.scan_registry(spark, paths["registry"]).select("best_model_type", "pr_auc", "is_deployed"))


register("monitoring_cycle")(_monitoring)
register("retrain_check")(_retrain_check)

# D15 without its time stamps: the cycle's summary, read back from the log it wrote -------------
from .q_metrics import BIN_SQL, LG10, SIDE_FM  # noqa: E402


def _monitoring_summary(spark, sf):
    paths = J.default_paths(_run_dir(spark, "monitoring"))
    J.monitoring_cycle(ev_a(spark, sf), paths)
    return REG.read_monitor_log(spark, paths["monitor_log"]).drop("timestamp", "monitoring_id")


register("monitoring_cycle_summary", with_ev(f"""
SELECT coalesce(mx > 0.1, false) AS drift_detected, {R('coalesce(mx, 0.0)')} AS max_drift_score,
       ch > 0.1 AS performance_degradation, {R('ch')} AS event_rate_change
FROM (SELECT max(psi) AS mx FROM psim),
     (SELECT CASE WHEN rr > 0 THEN abs(cr - rr) / rr ELSE 0.0 END AS ch FROM (
        SELECT count(*) FILTER (WHERE side = 'reference') / greatest(count(DISTINCT userId) FILTER (WHERE side = 'reference'), 1) AS rr,
               count(*) FILTER (WHERE side = 'current') / greatest(count(DISTINCT userId) FILTER (WHERE side = 'current'), 1) AS cr
        FROM es))""", "A", SIDE_FM + "," + LG10 + "," + BIN_SQL.format(src="lg10")))(_monitoring_summary)


# R3 with a deployed model: the decision on new data, nothing retrained ------------------------
def _retrain_decision(spark, sf):
    paths = J.default_paths(_run_dir(spark, "decision"))
    at = dt.datetime.fromisoformat
    REG.append(spark.createDataFrame(
        [("none", "logistic_regression", at("2024-01-29"), at("2024-01-25"), 0.82, 0.9, 0.8, 0.8, 0.8, ["x"],
          at("2024-01-29"), True)], REG.REGISTRY_SCHEMA), paths["registry"])
    t = J.retrain_check(ev_a(spark, sf), paths, now=at("2024-01-31"), run_retrain=False)
    return t.select("schedule_trigger", "performance_trigger", "data_volume_trigger", "new_events", "new_users",
                    F.lit(REG.read_retrain_log(spark, paths["retrain_log"]).first()["event_type"]).alias("event_type"))


register("retrain_check_decision", with_ev("""
SELECT false AS schedule_trigger, false AS performance_trigger, count(*) >= 100 AS data_volume_trigger,
       count(*) AS new_events, count(DISTINCT userId) AS new_users, 'retraining_check' AS event_type
FROM ev WHERE ts > TIMESTAMP '2024-01-25'"""))(_retrain_decision)


# S1 + P4: the event log as JSON lines, scanned back -------------------------------------
def _scan(spark, sf):
    path = _run_dir(spark, "eventlog")
    EL.write_event_log(ev_a(spark, sf), path)
    ev = preprocess_events(EL.scan_event_log(spark, path))
    return ev.groupBy("page").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("userId").alias("users"))


register("scan_event_log", with_ev("SELECT page, count(*) AS events, count(DISTINCT userId) AS users FROM ev GROUP BY 1"))(
    _scan)


def _scan_rows(spark, sf):
    path = _run_dir(spark, "eventlog")
    EL.write_event_log(ev_a(spark, sf), path)
    ev = preprocess_events(EL.scan_event_log(spark, path))
    return ev.select("userId", F.unix_millis("ts").alias("ts_ms"), F.unix_millis("registration").alias("registration_ms"),
                     "page", "level", "artist", "song", F.col("length").cast("double").alias("length"))


register("scan_event_log_rows", with_ev(f"""
SELECT userId, epoch_us(ts) // 1000 AS ts_ms, epoch_us(registration) // 1000 AS registration_ms, page, level, artist, song,
       {R('CAST(length AS DOUBLE)')} AS length FROM ev"""))(_scan_rows)


# The newest 100 entries of the monitoring log, one entry for each hour with events ---------
def _retention(spark, sf):
    path = f"{_run_dir(spark, 'retention')}/monitor_log"
    hours = ev_a(spark, sf).groupBy(F.date_trunc("hour", "ts").alias("timestamp")).agg(F.count(F.lit(1)).alias("n"))
    REG.sink_monitor_log(hours.select(
        "timestamp", F.date_format("timestamp", "yyyyMMdd_HHmm").alias("monitoring_id"), (F.col("n") > 1).alias("drift_detected"),
        F.col("n").cast("double").alias("max_drift_score"), F.lit(False).alias("performance_degradation"),
        F.lit(0.0).alias("event_rate_change")), path)
    return REG.read_monitor_log(spark, path).select(F.unix_seconds("timestamp").alias("at"), "monitoring_id",
                                                    "drift_detected", "max_drift_score")


register("monitor_log_retention", with_ev("""
SELECT CAST(epoch(h) AS BIGINT) AS at, strftime(h, '%Y%m%d_%H%M') AS monitoring_id, n > 1 AS drift_detected,
       CAST(n AS DOUBLE) AS max_drift_score
FROM (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM ev GROUP BY 1 ORDER BY 1 DESC LIMIT 100)"""))(_retention)


# T1-T3 -----------------------------------------------------------------------------
def _t1(spark, sf):
    run = _run_dir(spark, "t1")
    ev = ev_a(spark, sf)
    late = F.dayofmonth("ts") <= 10          # the older events arrive in the second run only
    for part in (~late, late):
        ev.filter(part).write.mode("append").partitionBy("event_date").parquet(f"{run}/source")
        ST.incremental_stream(spark, f"{run}/source", f"{run}/out", f"{run}/ckpt")
    return spark.read.parquet(f"{run}/out").groupBy(F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("events"))


register("incremental_stream", with_ev("SELECT CAST(ts AS DATE) AS date, count(*) AS events FROM ev GROUP BY 1"))(_t1)


def _t2(spark, sf):
    run = _run_dir(spark, "t2")
    ST.rate_stream(spark, activity_events_path(spark, sf), f"{run}/out", f"{run}/ckpt")
    return ST.read_rates(spark, f"{run}/out")


# the sketches are exact for so few users as these tables have
register("rate_stream", with_ev("""
SELECT date_trunc('day', ts) AS day_start, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end, count(*) AS events,
       count(DISTINCT userId) AS approx_users FROM ev GROUP BY 1, 2"""))(lambda spark, sf: _t2(spark, sf).drop("users"))
register("event_rate_proxy_from_rates", with_ev(f"""
SELECT {R('rr')} AS reference_event_rate, {R('cr')} AS current_event_rate, {R('abs(cr - rr) / rr')} AS event_rate_change,
       abs(cr - rr) / rr > 0.1 AS performance_degradation
FROM (SELECT count(*) FILTER (WHERE d < DATE '2024-01-21') / count(DISTINCT userId) FILTER (WHERE d < DATE '2024-01-21') AS rr,
             count(*) FILTER (WHERE d >= DATE '2024-01-21') / count(DISTINCT userId) FILTER (WHERE d >= DATE '2024-01-21') AS cr
      FROM (SELECT userId, CAST(ts AS DATE) AS d FROM ev))"""))(
    lambda spark, sf: D.event_rate_proxy_from_rates(_t2(spark, sf), dt.date(2024, 1, 21)))
register("rate_stream_events", with_ev("SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM ev GROUP BY 1"))(
    lambda spark, sf: _t2(spark, sf).select(F.to_date("day_start").alias("day"), "events"))


def _t3(spark, sf):
    run = _run_dir(spark, "t3")
    fm = X.feature_matrix(ev_a(spark, sf), CUTOFF_A)
    fm.write.parquet(f"{run}/features")
    ST.score_stream(spark, f"{run}/features", fm.schema, f"{run}/out", f"{run}/ckpt", S.NUMERIC_FEATURES)
    return spark.read.parquet(f"{run}/out/summary")


register("score_stream")(_t3)


def _t3_rows(spark, sf):
    """All scores of the stream, whatever batches the rows came in."""
    run = _run_dir(spark, "t3")
    fm = X.feature_matrix(ev_a(spark, sf), CUTOFF_A)
    fm.write.parquet(f"{run}/features")
    ST.score_stream(spark, f"{run}/features", fm.schema, f"{run}/out", f"{run}/ckpt", S.NUMERIC_FEATURES)
    return spark.read.parquet(f"{run}/out/scores").select("userId", "churn_probability", "churn_prediction", "risk_level")


register("score_stream_rows", "SELECT userId, churn_probability, churn_prediction, risk_level FROM ("
         + ORACLE["score_users"] + ")")(_t3_rows)


# What was written is read back ----------------------------------------------
def _report_back(spark, sf):
    """The newest of two stored drift reports, the older one of another threshold."""
    path = f"{_run_dir(spark, 'reports')}/drift_reports"
    scores, _ = D.engineered_drift(ev_a(spark, sf))
    for run, report in (("20240101_0000", scores.withColumn("drift_detected", F.lit(None).cast("boolean"))), ("20240201_0000", scores)):
        REG.sink_drift_report(report, path, run)
    return REG.latest_drift_report(spark, path).drop("run_id")


register("drift_report_read_back", ORACLE["engineered_drift_scores"])(_report_back)


def _perf_back(spark, sf):
    """Performance entries, one for each day and appended day by day order aside, read back from their log."""
    path = f"{_run_dir(spark, 'perf')}/perf_log"
    log = QUERIES["daily_performance_log"](spark, sf)
    odd = F.dayofmonth("timestamp") % 2 == 1
    for part in (odd, ~odd):
        REG.sink_perf_log(log.filter(part), path)
    return REG.read_perf_log(spark, path).select(*log.columns)


register("perf_log_read_back", ORACLE["daily_performance_log"])(_perf_back)


def _resolved_model(spark, sf):
    """Two models are saved, the older one deployed; a third row names files that do not exist.  The deployed one is resolved and scores."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    run = _run_dir(spark, "registry")
    docs = (read_table(spark, sf, "documents").join(read_table(spark, sf, "labels"), "doc_id")
            .select(F.col("doc_id").cast("string").alias("userId"), F.col("n_chars").cast("double").alias("n_chars"), F.col("quality").cast("double").alias("label")))
    steps = [VectorAssembler(inputCols=["n_chars"], outputCol="features", handleInvalid="keep"), LogisticRegression(maxIter=2)]
    fitted = Pipeline(stages=steps).fit(docs.na.fill(0.0))
    paths = [REG.save_model(fitted, f"{run}/registry", f"{run}/models", {"pr_auc": 0.5 + k / 10}, kind, ["n_chars"], None, deployed,
                            dt.datetime(2024, 1, 1 + k)) for k, (kind, deployed) in enumerate((("deployed", True), ("newer", False)))]
    gone = spark.createDataFrame([(f"{run}/models/none", "gone", None, None, 0.9, None, None, None, None, ["n_chars"],
                                   dt.datetime(2024, 3, 1), True)], REG.REGISTRY_SCHEMA)
    REG.append(gone, f"{run}/registry")
    model, row = REG.load_latest_model(spark, f"{run}/registry", PipelineModel.load)
    scored = model.transform(docs.na.fill(0.0))
    return scored.agg(F.lit(row["best_model_type"]).alias("model_type"), F.lit(row["pr_auc"]).alias("pr_auc"),
                      F.lit(row["model_path"] == paths[0]).alias("is_saved_path"), F.lit(row["is_deployed"]).alias("is_deployed"),
                      F.count(F.lit(1)).alias("scored"), F.count("prediction").alias("predictions"))


register("resolved_model", """
SELECT 'deployed' AS model_type, CAST(0.5 AS DOUBLE) AS pr_auc, true AS is_saved_path, true AS is_deployed, count(*) AS scored,
       count(*) AS predictions FROM documents JOIN labels USING (doc_id)""")(_resolved_model)


def _score_latest(spark, sf):
    """Train and deploy the best of all models, then score with the model the registry resolves (S7 -> S8 -> D1 -> D2, D13 -> S5)."""
    paths = J.default_paths(_run_dir(spark, "scoring"))
    ev = ev_a(spark, sf)
    J.retrain_job(ev, paths, inactivity_days=N)
    _, summary = J.score_with_latest_model(ev, paths, CUTOFF_A, labels=L.churn_labels(ev, N))
    return combine_rows(summary, REG.read_perf_log(spark, paths["perf_log"]).select("num_predictions", "accuracy"))


register("score_with_latest_model")(_score_latest)

# F6 ----------------------------------------------------------------------------
from ..operators.prep import contract_check, feature_projection  # noqa: E402

register("feature_projection", with_ev(
    "SELECT userId, " + ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), 0.0)')} AS {c}" for c in S.NUMERIC_FEATURES)
    + ", CAST(is_churned AS INTEGER) AS is_churned FROM tset", "A", TS_CTES))(
    lambda spark, sf: feature_projection(_model_df(spark, sf)))

# F10 ---------------------------------------------------------------------------
_REQ = ["userId"] + S.NUMERIC_FEATURES
register("contract_check", with_ev(
    "SELECT userId, list_filter([" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _REQ)
    + "], lambda x: x IS NOT NULL) AS missing_fields, " + " AND ".join(f"{c} IS NOT NULL" for c in _REQ)
    + " AS valid FROM (" + fm_select("fm", None) + ")", "A", feature_ctes(CUTOFF_A)))(
    lambda spark, sf: contract_check(X.feature_matrix(ev_a(spark, sf), CUTOFF_A).select("userId", *S.NUMERIC_FEATURES))
    .select("userId", "missing_fields", "valid"))
