"""Metrics (W5, M9-M12, M14), scoring (D1, D2), drift (D3-D12), monitoring
(D13, D14, K5) and decisions (R1, R2, F2, F3)."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..catalog import CUTOFF_A, INACTIVITY_A, ORACLE, ev_a, register
from ..operators import drift as D
from ..operators import evaluate as V
from ..operators import features as X
from ..operators import labels as L
from ..operators import monitor as M
from ..operators import scoring as SC
from ..operators.prep import incremental_events, reference_current_split
from ..operators.scalars import combine_rows
from ..oracle import R, days, with_ev
from ..sources.adapters import read_table
from .q_features import _LAB_FOR_JOIN, feature_ctes

N = INACTIVITY_A
BASELINE_PR_AUC = 0.982
DEFAULT_CURRENT_PR_AUC = 0.8     # default current performance of the retraining check

# --------------------------------------------------------------------------------
# metric fixture: labels x documents
# --------------------------------------------------------------------------------
MF = """
mf AS (SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label, CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS score
       FROM labels l JOIN documents d USING (doc_id)),
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
      FROM mf GROUP BY score),
cc AS (SELECT score, pos, neg,
         CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS BIGINT) AS P, CAST(sum(neg) OVER () AS BIGINT) AS N FROM g),
pts AS (SELECT score, tp / P AS recall, tp / (tp + fp) AS precision FROM cc),
pts_l AS (SELECT recall, precision, coalesce(lag(recall) OVER w, 0) AS recall_prev,
                 coalesce(lag(precision) OVER w, 1) AS precision_prev FROM pts WINDOW w AS (ORDER BY score DESC)),
pr AS (SELECT sum((recall - recall_prev) * (precision + precision_prev) / 2) AS pr_auc FROM pts_l),
ranks AS (SELECT score, pos, neg, coalesce(sum(pos + neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                                 AND 1 PRECEDING), 0) AS before FROM g),
roc AS (SELECT (sum(pos * (before + (pos + neg + 1) / 2.0)) - (sum(pos) * (sum(pos) + 1)) / 2.0)
               / (sum(pos) * sum(neg)) AS roc_auc FROM ranks),
thr AS (SELECT count(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND score > 0.5) AS fp,
               count(*) FILTER (WHERE label = 1 AND score <= 0.5) AS fn, count(*) FILTER (WHERE label <> 1 AND score <= 0.5) AS tn
        FROM mf),
thm AS (SELECT tp, fp, fn, tn,
          CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score,
          CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM thr),
rap AS (SELECT coalesce(max(recall) FILTER (WHERE precision >= 0.9), 0) AS recall_at_90_precision,
               coalesce(max(recall) FILTER (WHERE precision >= 0.8), 0) AS recall_at_80_precision FROM pts)"""


def _mf(spark, sf):
    return V.metric_fixture(read_table(spark, sf, "labels"), read_table(spark, sf, "documents"))


def _sql(body):
    """Metric-fixture SQL needs no event adapter."""
    return "WITH " + MF.strip() + "\n" + body


register("cumulative_confusion", _sql("SELECT score, pos, neg, tp, fp, P, N FROM cc"))(
    lambda spark, sf: V.cumulative_confusion(_mf(spark, sf)).select("score", "pos", "neg", "tp", "fp", "P", "N"))
register("roc_auc", _sql(f"SELECT {R('roc_auc')} AS roc_auc FROM roc"))(lambda spark, sf: V.roc_auc(_mf(spark, sf)))
register("pr_auc", _sql(f"SELECT {R('pr_auc')} AS pr_auc FROM pr"))(lambda spark, sf: V.pr_auc(_mf(spark, sf)))
register("threshold_metrics", _sql(
    f"SELECT tp, fp, fn, tn, {R('f1_score')} AS f1_score, {R('precision')} AS precision, {R('recall')} AS recall "
    "FROM thm"))(lambda spark, sf: V.threshold_metrics(_mf(spark, sf)))
register("recall_at_precision", _sql(
    f"SELECT {R('recall_at_90_precision')} AS recall_at_90_precision, "
    f"{R('recall_at_80_precision')} AS recall_at_80_precision FROM rap"))(
    lambda spark, sf: V.recall_at_precision(_mf(spark, sf)))
register("classification_report", _sql(
    f"SELECT {R('roc_auc')} AS roc_auc, {R('pr_auc')} AS pr_auc, {R('f1_score')} AS f1_score, "
    f"{R('precision')} AS precision, {R('recall')} AS recall, {R('recall_at_90_precision')} AS recall_at_90_precision, "
    f"{R('recall_at_80_precision')} AS recall_at_80_precision FROM roc, pr, thm, rap"))(
    lambda spark, sf: V.classification_report(_mf(spark, sf)))

_LOGP = """
SELECT count(*) AS num_predictions, {acc} AS accuracy, {prec} AS precision, {rec} AS recall, {f1} AS f1_score,
  {cr} AS churn_rate, {pr} AS prediction_rate, {avg} AS avg_churn_probability FROM mf"""
_P = "CAST(sum(CAST(label = 1 AND score > 0.5 AS INTEGER)) AS DOUBLE) / greatest(sum(CAST(score > 0.5 AS INTEGER)), 1)"
_RC = "CAST(sum(CAST(label = 1 AND score > 0.5 AS INTEGER)) AS DOUBLE) / greatest(sum(label), 1)"
register("log_performance", _sql(_LOGP.format(
    acc=R("avg(CAST((label = 1) = (score > 0.5) AS DOUBLE))"), prec=R(_P), rec=R(_RC),
    f1=R(f"2 * ({_P}) * ({_RC}) / greatest(({_P}) + ({_RC}), 1e-8)"), cr=R("avg(CAST(label AS DOUBLE))"),
    pr=R("avg(CAST(score > 0.5 AS DOUBLE))"), avg=R("avg(score)"))))(
    lambda spark, sf: V.log_performance(_mf(spark, sf)))

# --------------------------------------------------------------------------------
# fixed linear model on the training set (scoring, error analysis, concept drift)
# --------------------------------------------------------------------------------
_Z = " + ".join([str(SC.FIXED_MODEL["intercept"])]
                + [f"{w} * coalesce(CAST({c} AS DOUBLE), 0.0)" for c, w in SC.FIXED_MODEL.items() if c != "intercept"])
TRAIN_CTES = feature_ctes(CUTOFF_A) + "," + _LAB_FOR_JOIN + f""",
scd AS (SELECT fm.userId, fm.total_events, coalesce(fm.days_since_registration, 0) AS days_since_registration,
               coalesce(fm.current_level_paid, 0) AS current_level_paid, (l.churn_type <> 'not_churned') AS is_churned,
               1.0 / (1.0 + exp(-({_Z}))) AS p
        FROM fm JOIN lab3 l USING (userId))"""


def _scored_training(spark, sf):
    ev = ev_a(spark, sf)
    ts = X.features_with_labels(X.feature_matrix(ev, CUTOFF_A), L.churn_labels(ev, N))
    return SC.fixed_linear_score(ts)


def _score_users(spark, sf):
    fm = X.feature_matrix(ev_a(spark, sf), CUTOFF_A)
    return SC.score_users(fm, S.NUMERIC_FEATURES, None, scored_at=CUTOFF_A)


_RISK = "CASE WHEN p >= 0.8 THEN 'high' WHEN p >= 0.5 THEN 'medium' ELSE 'low' END"
register("score_users", with_ev(f"""
SELECT userId, {R('p')} AS churn_probability, p >= 0.5 AS churn_prediction, {_RISK} AS risk_level,
       TIMESTAMP '{CUTOFF_A}' AS prediction_timestamp FROM scd""", "A", TRAIN_CTES))(_score_users)
register("score_summary", with_ev(f"""
SELECT count(*) AS total_users, count(*) FILTER (WHERE p >= 0.8) AS high_risk_users,
  count(*) FILTER (WHERE p >= 0.5 AND p < 0.8) AS medium_risk_users, count(*) FILTER (WHERE p < 0.5) AS low_risk_users,
  {R('avg(p)')} AS avg_churn_probability, {R('max(p)')} AS max_churn_probability, {R('min(p)')} AS min_churn_probability
FROM scd""", "A", TRAIN_CTES))(lambda spark, sf: SC.score_summary(_score_users(spark, sf)))

register("error_analysis", with_ev(f"""
SELECT k.error_type, coalesce(a.count, 0) AS count, {R('coalesce(a.t, 0.0)')} AS avg_total_events,
  {R('coalesce(a.d, 0.0)')} AS avg_days_since_registration, {R('coalesce(a.pp, 0.0)')} AS paid_users_pct
FROM (VALUES ('false_positive'), ('false_negative')) k(error_type) LEFT JOIN (
  SELECT CASE WHEN NOT is_churned AND p > 0.5 THEN 'false_positive' ELSE 'false_negative' END AS error_type,
         count(*) AS count, avg(total_events) AS t, avg(days_since_registration) AS d, avg(current_level_paid) * 100 AS pp
  FROM scd WHERE (NOT is_churned AND p > 0.5) OR (is_churned AND p <= 0.5) GROUP BY 1) a USING (error_type)""",
    "A", TRAIN_CTES))(lambda spark, sf: V.error_analysis(_scored_training(spark, sf)))

register("model_metrics_fixed", with_ev(f"""
SELECT {R('roc_auc')} AS roc_auc, {R('pr_auc')} AS pr_auc FROM roc, pr""", "A", TRAIN_CTES + "," + MF.replace(
    "mf AS (SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label, CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS score\n"
    "       FROM labels l JOIN documents d USING (doc_id))",
    "mf AS (SELECT userId, CAST(is_churned AS INTEGER) AS label, p AS score FROM scd)")))(
    lambda spark, sf: V.classification_report(_scored_training(spark, sf).select(
        F.col("is_churned").cast("int").alias("label"), F.col("churn_probability").alias("score")))
    .select("roc_auc", "pr_auc"))

register("concept_drift", with_ev(f"""
SELECT {R('acc')} AS accuracy, {R('prec')} AS precision, {R('rec')} AS recall,
  {R('0.9 - acc')} AS accuracy_drop, {R('0.9 - prec')} AS precision_drop, {R('0.85 - rec')} AS recall_drop,
  (0.9 - acc > 0.1 OR 0.9 - prec > 0.1 OR 0.85 - rec > 0.1) AS concept_drift_detected, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT avg(CAST(CAST(is_churned AS INTEGER) = CAST(p > 0.5 AS INTEGER) AS DOUBLE)) AS acc,
             sum(CAST(is_churned AND p > 0.5 AS INTEGER)) / greatest(sum(CAST(p > 0.5 AS INTEGER)), 1) AS prec,
             sum(CAST(is_churned AND p > 0.5 AS INTEGER)) / greatest(sum(CAST(is_churned AS INTEGER)), 1) AS rec
      FROM scd)""", "A", TRAIN_CTES))(lambda spark, sf: D.concept_drift(_scored_training(spark, sf)))

# --------------------------------------------------------------------------------
# drift on raw event values (KS, mean shift, categorical PSI, bin PSI)
# --------------------------------------------------------------------------------
SPLIT_RAW = """
sp_b AS (SELECT make_timestamp(CAST(floor(quantile_cont(epoch_us(CAST(ts AS TIMESTAMP)), 0.7)) AS BIGINT)) AS b
         FROM events),
sp AS (SELECT e.*, CAST(json_extract(e.props, '$.k') AS DOUBLE) AS k,
              CASE WHEN CAST(e.ts AS TIMESTAMP) <= sp_b.b THEN 'reference' ELSE 'current' END AS side
       FROM events e, sp_b),
lg AS (SELECT side, 'value' AS feature, value AS v FROM sp WHERE value IS NOT NULL
       UNION ALL SELECT side, 'k', k FROM sp WHERE k IS NOT NULL)"""


def _raw_long(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")) \
        .withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    s = reference_current_split(ev)
    return D.to_long(s.filter(D.is_ref()), s.filter(D.is_cur()), ["value", "k"])


def _raw_sql(body, extra=""):
    return "WITH " + SPLIT_RAW.strip() + ("," + extra if extra else "") + "\n" + body


KS_SQL = """
ks_c AS (SELECT feature, v, count(*) FILTER (WHERE side = 'reference') AS r, count(*) FILTER (WHERE side = 'current') AS c
         FROM {src} GROUP BY 1, 2),
ks_w AS (SELECT feature, v, sum(r) OVER (PARTITION BY feature ORDER BY v) AS cr, sum(c) OVER (PARTITION BY feature ORDER BY v) AS cc,
                sum(r) OVER (PARTITION BY feature) AS nr, sum(c) OVER (PARTITION BY feature) AS nc FROM ks_c),
ks AS (SELECT feature, max(abs(cr / nr - cc / nc)) AS ks_statistic, CAST(max(nr) AS BIGINT) AS n_ref,
              CAST(max(nc) AS BIGINT) AS n_cur FROM ks_w GROUP BY feature)"""
register("ks_numeric", _raw_sql(f"SELECT feature, {R('ks_statistic')} AS ks_statistic, n_ref, n_cur FROM ks",
                                KS_SQL.format(src="lg")))(lambda spark, sf: D.ks_numeric(_raw_long(spark, sf)))

register("mean_shift", _raw_sql(f"""
SELECT feature, {R('ref_mean')} AS ref_mean, {R('new_mean')} AS new_mean, {R('ref_std')} AS ref_std,
  {R("abs(ref_mean - new_mean) / CASE WHEN ref_std IS NULL OR ref_std = 0 THEN 1.0 ELSE ref_std END")} AS mean_shift
FROM (SELECT feature, avg(v) FILTER (WHERE side = 'reference') AS ref_mean, avg(v) FILTER (WHERE side = 'current') AS new_mean,
             stddev_samp(v) FILTER (WHERE side = 'reference') AS ref_std FROM lg GROUP BY feature)"""))(
    lambda spark, sf: D.mean_shift(_raw_long(spark, sf)))


def _cat_long(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = reference_current_split(ev)
    return D.to_long(s.filter(D.is_ref()), s.filter(D.is_cur()), ["event_type"], "string")


PSI_CAT_SQL = """
pc_c AS (SELECT feature, side, v, count(*) AS n FROM {src} GROUP BY 1, 2, 3),
pc_s AS (SELECT feature, side, v, n / sum(n) OVER (PARTITION BY feature, side) AS share FROM pc_c),
pc_j AS (SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.v, b.v) AS v,
                coalesce(a.share, 0.001) AS ref_share, coalesce(b.share, 0.001) AS new_share
         FROM (SELECT * FROM pc_s WHERE side = 'reference') a
         FULL OUTER JOIN (SELECT * FROM pc_s WHERE side = 'current') b ON a.feature = b.feature AND a.v = b.v),
psic AS (SELECT feature, abs(sum((new_share - ref_share) * ln(new_share / ref_share))) AS psi FROM pc_j GROUP BY 1)"""
register("psi_categorical", _raw_sql(f"SELECT feature, {R('psi')} AS psi FROM psic", """
lgc AS (SELECT side, 'event_type' AS feature, event_type AS v FROM sp WHERE event_type IS NOT NULL),""" + PSI_CAT_SQL.format(
    src="lgc")))(lambda spark, sf: D.psi_categorical(_cat_long(spark, sf)))
register("category_outer_align", _raw_sql(
    f"SELECT feature, v AS value, {R('ref_share')} AS ref_share, {R('new_share')} AS new_share FROM pc_j", """
lgc AS (SELECT side, 'event_type' AS feature, event_type AS v FROM sp WHERE event_type IS NOT NULL),""" + PSI_CAT_SQL.format(
        src="lgc")))(lambda spark, sf: D.category_shares(_cat_long(spark, sf)))

BIN_SQL = """
bn_r AS (SELECT feature, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
         FROM {src} WHERE side = 'reference' GROUP BY 1),
bn_g AS (SELECT feature, i AS bin, CAST(i AS DOUBLE) * ((hi - lo) / 10.0) + lo AS blo,
                CASE WHEN i = 9 THEN hi ELSE CAST(i + 1 AS DOUBLE) * ((hi - lo) / 10.0) + lo END AS bhi
         FROM bn_r, range(0, 10) t(i)),
bn_t AS (SELECT feature, count(*) FILTER (WHERE side = 'reference') AS n_ref, count(*) FILTER (WHERE side = 'current') AS n_cur
         FROM {src} GROUP BY 1),
bn AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE x.side = 'reference') AS ref_count,
              count(*) FILTER (WHERE x.side = 'current') AS cur_count
       FROM bn_g g LEFT JOIN {src} x ON x.feature = g.feature AND x.v >= g.blo
            AND (x.v < g.bhi OR (g.bin = 9 AND x.v <= g.bhi))
       GROUP BY 1, 2),
bnx AS (SELECT bn.*, t.n_ref, t.n_cur, sum(ref_count) OVER (PARTITION BY bn.feature) AS sr,
               sum(cur_count) OVER (PARTITION BY bn.feature) AS sc FROM bn JOIN bn_t t USING (feature)),
psim AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM (
           SELECT feature, CASE WHEN ref_count = 0 THEN 0.0001 ELSE ref_count / n_ref END AS e,
                  CASE WHEN cur_count = 0 THEN 0.0001 ELSE cur_count / n_cur END AS a FROM bnx) GROUP BY 1),
psir AS (SELECT feature, abs(sum((c - r) * ln(c / r))) AS psi FROM (
           SELECT feature, (ref_count + 1e-6) / (sr + 10 * 1e-6) AS r, (cur_count + 1e-6) / (sc + 10 * 1e-6) AS c
           FROM bnx) GROUP BY 1)"""
register("psi_monitor", _raw_sql(f"SELECT feature, {R('psi')} AS psi FROM psim", BIN_SQL.format(src="lg")))(
    lambda spark, sf: D.psi_monitor(_raw_long(spark, sf)))
register("psi_retrain", _raw_sql(f"SELECT feature, {R('psi')} AS psi FROM psir", BIN_SQL.format(src="lg")))(
    lambda spark, sf: D.psi_retrain(_raw_long(spark, sf)))
register("bin_align", _raw_sql("SELECT feature, CAST(bin AS INTEGER) AS bin, ref_count, cur_count, n_ref, n_cur FROM bnx",
                               BIN_SQL.format(src="lg")))(lambda spark, sf: D.binned_counts(_raw_long(spark, sf)))

# --------------------------------------------------------------------------------
# engineered-feature drift (D8, D9, D10) and event-rate proxy
# --------------------------------------------------------------------------------
SPLIT_EV = """
es_b AS (SELECT make_timestamp(CAST(floor(quantile_cont(epoch_us(ts), 0.7)) AS BIGINT)) AS b FROM ev),
es AS (SELECT ev.*, CASE WHEN ts <= es_b.b THEN 'reference' ELSE 'current' END AS side FROM ev, es_b),
evk AS (SELECT * REPLACE (side || chr(1) || userId AS userId) FROM es)"""
SIDE_FM = SPLIT_EV + "," + feature_ctes(None, "evk") + """,
sfm AS (SELECT split_part(userId, chr(1), 1) AS side, * REPLACE (split_part(userId, chr(1), 2) AS userId) FROM fm)"""
_F10 = S.NUMERIC_FEATURES[:10]
LG10 = "lg10 AS (" + " UNION ALL ".join(
    f"SELECT side, '{c}' AS feature, CAST(coalesce({c}, 0) AS DOUBLE) AS v FROM sfm" for c in _F10) + ")"


def _eng(spark, sf, variant="monitor"):
    return D.engineered_drift(ev_a(spark, sf), variant=variant)


register("engineered_drift_scores", with_ev(
    f"SELECT feature, {R('psi')} AS psi, psi > 0.1 AS drift_detected FROM psim", "A",
    SIDE_FM + "," + LG10 + "," + BIN_SQL.format(src="lg10")))(lambda spark, sf: _eng(spark, sf)[0])
register("engineered_drift", with_ev(f"""
SELECT coalesce(max(psi) > 0.1, false) AS drift_detected, {R('coalesce(max(psi), 0.0)')} AS max_drift_score,
  count(*) FILTER (WHERE psi > 0.1) AS features_with_drift, CAST(0.1 AS DOUBLE) AS threshold,
  CASE WHEN (SELECT count(*) FROM sfm WHERE side = 'current') = 0 THEN 'no_new_data' END AS reason FROM psim""", "A",
    SIDE_FM + "," + LG10 + "," + BIN_SQL.format(src="lg10")))(lambda spark, sf: _eng(spark, sf)[1])
register("engineered_drift_retrain", with_ev(
    f"SELECT feature, {R('psi')} AS psi, psi > 0.1 AS drift_detected FROM psir", "A",
    SIDE_FM + "," + LG10 + "," + BIN_SQL.format(src="lg10")))(lambda spark, sf: _eng(spark, sf, "retrain")[0])


def _fd(spark, sf):
    fm = D.side_feature_matrices(ev_a(spark, sf))
    return D.feature_drift_sided(fm, S.FEATURE_COLUMNS)


_LGALL = "lgall AS (" + " UNION ALL ".join(
    f"SELECT side, '{c}' AS feature, CAST(coalesce({c}, 0) AS DOUBLE) AS v FROM sfm" for c in S.NUMERIC_FEATURES) + ")"
_LGST = "lgst AS (SELECT side, 'location_state' AS feature, location_state AS v FROM sfm WHERE location_state IS NOT NULL)"
_MEANS = ("mn AS (SELECT feature, avg(v) FILTER (WHERE side = 'reference') AS ref_mean, "
          "avg(v) FILTER (WHERE side = 'current') AS new_mean FROM lgall GROUP BY 1)")
FD_CTES = (SIDE_FM + "," + _LGALL + "," + _LGST + "," + KS_SQL.format(src="lgall").replace("v ", "v ") + ","
           + PSI_CAT_SQL.format(src="lgst") + "," + _MEANS + """,
fdr AS (
  SELECT ks.feature, ks_statistic AS drift_score, ks_statistic > 0.1 AS drift_detected, 'kolmogorov_smirnov' AS method,
         mn.ref_mean, mn.new_mean FROM ks JOIN mn USING (feature)
  UNION ALL
  SELECT feature, psi, psi > 0.1, 'population_stability_index', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM psic)""")
register("feature_drift", with_ev(
    f"SELECT feature, {R('drift_score')} AS drift_score, drift_detected, method, {R('ref_mean')} AS ref_mean, "
    f"{R('new_mean')} AS new_mean FROM fdr", "A", FD_CTES))(
    _fd)
register("data_drift_report", with_ev(f"""
SELECT bool_or(drift_detected) AS overall_drift_detected, count(*) FILTER (WHERE drift_detected) AS num_features_with_drift,
  coalesce(list_sort(list(feature) FILTER (WHERE drift_detected)), []) AS features_with_drift,
  {R('coalesce(max(drift_score), 0.0)')} AS max_drift_score, {R('coalesce(avg(drift_score), 0.0)')} AS avg_drift_score
FROM fdr""", "A", FD_CTES))(lambda spark, sf: D.drift_summary(_fd(spark, sf))[1])



def _report_of_frames(spark, sf):
    """D9 on two frames of a caller: the features are chosen by their columns."""
    fm = D.side_feature_matrices(ev_a(spark, sf)).select("side", "userId", *S.FEATURE_COLUMNS)
    ref, cur = (fm.filter(F.col("side") == s).drop("side") for s in (D.REF, D.CUR))
    return D.data_drift_report(ref, cur)[1]


register("data_drift_report_frames", ORACLE["data_drift_report"])(_report_of_frames)

register("event_rate_proxy", with_ev(f"""
SELECT {R('rr')} AS reference_event_rate, {R('cr')} AS current_event_rate, {R('ch')} AS event_rate_change,
       ch > 0.1 AS performance_degradation
FROM (SELECT rr, cr, CASE WHEN rr > 0 THEN abs(cr - rr) / rr ELSE 0.0 END AS ch FROM (
  SELECT CASE WHEN count(*) FILTER (WHERE side = 'reference') > 0 THEN count(*) FILTER (WHERE side = 'reference')
              / count(DISTINCT userId) FILTER (WHERE side = 'reference') ELSE 0.0 END AS rr,
         CASE WHEN count(*) FILTER (WHERE side = 'current') > 0 THEN count(*) FILTER (WHERE side = 'current')
              / count(DISTINCT userId) FILTER (WHERE side = 'current') ELSE 0.0 END AS cr FROM es))""", "A", SPLIT_EV))(
    lambda spark, sf: D.event_rate_proxy(reference_current_split(ev_a(spark, sf))))

register("reference_current_split", with_ev("""
SELECT side, count(*) AS events, count(DISTINCT userId) AS users, min(ts) AS first_ts, max(ts) AS last_ts
FROM es GROUP BY side""", "A", SPLIT_EV))(
    lambda spark, sf: reference_current_split(ev_a(spark, sf)).groupBy("side").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("userId").alias("users"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))

# --------------------------------------------------------------------------------
# daily performance log (D13 per day), trend (D14), last entries (K5)
# --------------------------------------------------------------------------------
DAILY_LOG = TRAIN_CTES + """,
dl_u AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, userId FROM ev),
dl_s AS (SELECT d.day, CAST(s.is_churned AS INTEGER) AS label, s.p FROM dl_u d JOIN scd s USING (userId)),
dlog AS (SELECT day AS timestamp, count(*) AS num_predictions,
           avg(CAST(label = CAST(p > 0.5 AS INTEGER) AS DOUBLE)) AS accuracy,
           sum(CAST(label = 1 AND p > 0.5 AS INTEGER)) / greatest(sum(CAST(p > 0.5 AS INTEGER)), 1) AS precision,
           sum(CAST(label = 1 AND p > 0.5 AS INTEGER)) / greatest(sum(label), 1) AS recall,
           avg(CAST(label AS DOUBLE)) AS churn_rate, avg(CAST(p > 0.5 AS DOUBLE)) AS prediction_rate,
           avg(p) AS avg_churn_probability FROM dl_s GROUP BY day),
dlog2 AS (SELECT *, 2 * precision * recall / greatest(precision + recall, 1e-8) AS f1_score FROM dlog)"""


def _daily_log(spark, sf):
    ev = ev_a(spark, sf)
    scored = SC.fixed_linear_score(X.features_with_labels(X.feature_matrix(ev, CUTOFF_A), L.churn_labels(ev, N)))
    days_ = ev.select(F.to_date("ts").cast("timestamp").alias("day"), "userId").distinct()
    j = days_.join(scored.select("userId", F.col("is_churned").cast("int").alias("label"),
                                 F.col("churn_probability").alias("score")), "userId")
    return M.performance_log_by_period(j, "day")


_DL_COLS = ["num_predictions", "accuracy", "precision", "recall", "f1_score", "churn_rate", "prediction_rate",
            "avg_churn_probability"]
register("daily_performance_log", with_ev(
    "SELECT timestamp, " + ", ".join(c if c == "num_predictions" else f"{R(c)} AS {c}" for c in _DL_COLS)
    + " FROM dlog2", "A", DAILY_LOG))(_daily_log)
register("last_k_entries", with_ev(
    "SELECT timestamp, " + ", ".join(c if c == "num_predictions" else f"{R(c)} AS {c}" for c in _DL_COLS)
    + " FROM dlog2 ORDER BY timestamp DESC LIMIT 5", "A", DAILY_LOG))(
    lambda spark, sf: M.last_k_entries(_daily_log(spark, sf), 5))
register("performance_trend", with_ev(f"""
SELECT metric, count(*) AS num_evaluations, {R('avg(v)')} AS mean, {R('stddev_pop(v)')} AS std,
       {R('regr_slope(v, idx)')} AS trend
FROM (SELECT *, CAST(row_number() OVER (ORDER BY timestamp) - 1 AS DOUBLE) AS idx
      FROM dlog2 WHERE timestamp > (SELECT max(timestamp) FROM dlog2) - INTERVAL 30 DAY)
UNPIVOT (v FOR metric IN (accuracy, precision, recall)) GROUP BY metric""", "A", DAILY_LOG))(
    lambda spark, sf: M.performance_trend(_daily_log(spark, sf), 30))

# --------------------------------------------------------------------------------
# F2 incremental events; R1 triggers; R2 gate
# --------------------------------------------------------------------------------
register("incremental_events", with_ev(f"""
SELECT count(*) AS new_events, count(DISTINCT userId) AS new_users, min(ts) AS first_ts
FROM ev WHERE ts > (SELECT max(ts) FROM ev) - INTERVAL 7 DAY"""))(
    lambda spark, sf: incremental_events(ev_a(spark, sf)).agg(
        F.count(F.lit(1)).alias("new_events"), F.countDistinct("userId").alias("new_users"), F.min("ts").alias("first_ts")))


def _triggers(spark, sf):
    ev = ev_a(spark, sf)
    new = incremental_events(ev, CUTOFF_A).agg(F.count(F.lit(1)).alias("new_events"),
                                               F.countDistinct("userId").alias("new_users"))
    _, rep = D.engineered_drift(ev, last_data_ts=CUTOFF_A, variant="retrain")
    inp = (combine_rows(ev.agg(F.max("ts").alias("now")), new, rep.select("max_drift_score"))
             .withColumn("last_training_time", F.lit(CUTOFF_A).cast("timestamp"))
             .withColumn("baseline_metric", F.lit(BASELINE_PR_AUC))
             .withColumn("current_metric", F.lit(DEFAULT_CURRENT_PR_AUC)))
    return M.retrain_triggers(inp)


_SPLIT_CUT = f"""
es AS (SELECT ev.*, CASE WHEN ts <= TIMESTAMP '{CUTOFF_A}' THEN 'reference' ELSE 'current' END AS side FROM ev),
evk AS (SELECT * REPLACE (side || chr(1) || userId AS userId) FROM es)"""
_TRIG_CTES = (_SPLIT_CUT + "," + feature_ctes(None, "evk") + """,
sfm AS (SELECT split_part(userId, chr(1), 1) AS side, * REPLACE (split_part(userId, chr(1), 2) AS userId) FROM fm),"""
              + LG10 + "," + BIN_SQL.format(src="lg10"))
_DAYS = days("now", f"TIMESTAMP '{CUTOFF_A}'")
register("retrain_triggers", with_ev(f"""
SELECT sched AS schedule_trigger, perf AS performance_trigger, drift AS drift_trigger, vol AS data_volume_trigger,
  (sched OR perf OR drift) AND vol AS should_retrain,
  list_filter([CASE WHEN sched THEN 'Scheduled retraining (' || CAST(dd AS VARCHAR) || ' days)' END,
               CASE WHEN perf THEN 'Performance drop: ' || printf('%.3f', {BASELINE_PR_AUC} - {DEFAULT_CURRENT_PR_AUC}) END,
               CASE WHEN drift THEN 'Data drift detected via PSI' END,
               CASE WHEN vol THEN 'Sufficient new data: ' || CAST(new_events AS VARCHAR) || ' events'
                    ELSE 'Insufficient data: ' || CAST(new_events AS VARCHAR) || ' < 100' END], lambda x: x IS NOT NULL) AS reasons,
  new_events, new_users
FROM (SELECT {_DAYS} >= 7 AS sched, {BASELINE_PR_AUC} - {DEFAULT_CURRENT_PR_AUC} > 0.1 AS perf,
             coalesce((SELECT max(psi) FROM psir) > 0.1, false) AS drift, new_events >= 100 AS vol, new_events, new_users,
             {_DAYS} AS dd
      FROM (SELECT max(ts) AS now FROM ev),
           (SELECT count(*) AS new_events, count(DISTINCT userId) AS new_users FROM ev
            WHERE ts > TIMESTAMP '{CUTOFF_A}'))""", "A", _TRIG_CTES))(_triggers)


def _gate(spark, sf):
    scored = _scored_training(spark, sf).select(F.col("is_churned").cast("int").alias("label"),
                                                 F.col("churn_probability").alias("score"))
    cand = V.pr_auc(scored).select(F.lit("fixed_linear").alias("model"), F.col("pr_auc").alias("new_metric"),
                                   F.lit(BASELINE_PR_AUC).alias("baseline_metric"))
    return M.deployment_gate(cand)


register("deployment_gate", with_ev(f"""
SELECT 'fixed_linear' AS model, {R('pr_auc')} AS new_metric, CAST({BASELINE_PR_AUC} AS DOUBLE) AS baseline_metric,
  {R(f'pr_auc - {BASELINE_PR_AUC}')} AS performance_improvement, pr_auc - {BASELINE_PR_AUC} >= 0.02 AS should_deploy
FROM pr""", "A", TRAIN_CTES + "," + MF.replace(
    "mf AS (SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label, CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS score\n"
    "       FROM labels l JOIN documents d USING (doc_id))",
    "mf AS (SELECT userId, CAST(is_churned AS INTEGER) AS label, p AS score FROM scd)")))(_gate)
