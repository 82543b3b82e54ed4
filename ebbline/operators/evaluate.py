"""Classification metrics as DataFrame plans.

Input everywhere: a frame with a 0/1 ``label`` and a ``score`` in [0, 1].
The curves are built once per distinct score (pre-aggregated, so ties are
one row and hot scores combine map-side) and summed in a global order by
:func:`ebbline.operators.cumulative.prefix_sums`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .cumulative import prefix_sums
from .scalars import attach_scalars, combine_rows


def metric_fixture(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """``labels`` join ``documents``: label = quality, score = (n_chars % 1000)/1000."""
    d = documents.select("doc_id", "n_chars")   # column pruning: the text is never read
    return (labels.select("doc_id", "quality").join(d, "doc_id")
                  .select("doc_id", F.col("quality").cast("int").alias("label"),
                          ((F.col("n_chars") % 1000) / 1000.0).alias("score")))


# W5 ----------------------------------------------------------------------------
def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score (ties are one row)."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def cumulative_confusion(df: DataFrame, label: str = "label", score: str = "score", counts=None) -> DataFrame:
    """One row per distinct score, descending: pos/neg at that score and the
    cumulative TP/FP of the threshold ``score >= s``, plus class totals."""
    g = counts if counts is not None else score_counts(df, label, score)
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = prefix_sums(g, "score", ["pos", "neg"], descending=True)
    return attach_scalars(c.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp"), tot)


def curve_points(conf: DataFrame) -> DataFrame:
    """Per threshold: recall, precision and fpr at it and at the previous
    (higher) threshold - the previous point is the cumulative minus this
    score's own counts, so no ordered lag is needed."""
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    P, N = F.col("P"), F.col("N")
    return conf.select(
        "score", "pos", "neg", "tp", "fp", "P", "N",
        F.try_divide(F.col("tp"), P.cast("double")).alias("recall"),
        F.try_divide(tp0, P.cast("double")).alias("recall_prev"),
        F.try_divide(F.col("tp"), (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0)).alias("precision_prev"),
        F.try_divide(F.col("fp"), N.cast("double")).alias("fpr"),
        F.try_divide(fp0, N.cast("double")).alias("fpr_prev"))


# M9 ----------------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area of the ROC curve = rank statistic with ties counted half;
    null with only one class."""
    p = curve_points(cumulative_confusion(df, label, score))
    area = F.sum((F.col("fpr") - F.col("fpr_prev")) * (F.col("recall") + F.col("recall_prev")) / 2)
    return p.agg(F.when((F.max("P") > 0) & (F.max("N") > 0), area).alias("roc_auc"))


# M10 ---------------------------------------------------------------------------
def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area of the precision-recall curve that starts at (recall 0,
    precision 1); null without positives."""
    p = curve_points(cumulative_confusion(df, label, score))
    area = F.sum((F.col("recall") - F.col("recall_prev")) * (F.col("precision") + F.col("precision_prev")) / 2)
    return p.agg(F.when(F.max("P") > 0, area).alias("pr_auc"))


# M11 / D13 ------------------------------------------------------------------------
def _confusion_counts(df: DataFrame, label: str, score: str, threshold: float, strict: bool) -> DataFrame:
    pred = (F.col(score) > threshold) if strict else (F.col(score) >= threshold)
    y = F.col(label) == 1
    return df.agg(F.count_if(y & pred).alias("tp"), F.count_if(~y & pred).alias("fp"),
                  F.count_if(y & ~pred).alias("fn"), F.count_if(~y & ~pred).alias("tn"),
                  F.avg(F.col(score)).alias("avg_score"))


def threshold_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """F1, precision, recall of ``score > threshold``; zero division -> 0."""
    c = _confusion_counts(df, label, score, threshold, True)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    return c.select("tp", "fp", "fn", "tn", f1.alias("f1_score"), prec.alias("precision"), rec.alias("recall"))


# M12 ---------------------------------------------------------------------------
def recall_at_precision(df: DataFrame, levels=(0.9, 0.8), label: str = "label", score: str = "score") -> DataFrame:
    """Largest recall among curve points with precision >= level, else 0."""
    p = curve_points(cumulative_confusion(df, label, score))
    return p.agg(*[F.coalesce(F.max(F.when(F.col("precision") >= lv, F.col("recall"))), F.lit(0.0))
                   .alias(f"recall_at_{int(round(lv * 100))}_precision") for lv in levels])


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5, levels=(0.9, 0.8)) -> DataFrame:
    """All model-comparison metrics in one row (M9-M12) from ONE per-score
    table: the curve, the areas, recall at precision and the threshold
    metrics are all aggregates of it.  The per-score table (at most one row
    per distinct score) is checkpointed so the input is read once."""
    g = staged(score_counts(df, label, score))
    p = curve_points(cumulative_confusion(df, counts=g))
    roc = F.sum((F.col("fpr") - F.col("fpr_prev")) * (F.col("recall") + F.col("recall_prev")) / 2)
    pr = F.sum((F.col("recall") - F.col("recall_prev")) * (F.col("precision") + F.col("precision_prev")) / 2)
    curve = p.agg(F.when((F.max("P") > 0) & (F.max("N") > 0), roc).alias("roc_auc"),
                  F.when(F.max("P") > 0, pr).alias("pr_auc"),
                  *[F.coalesce(F.max(F.when(F.col("precision") >= lv, F.col("recall"))), F.lit(0.0))
                    .alias(f"recall_at_{int(round(lv * 100))}_precision") for lv in levels])
    above = F.col("score") > threshold
    c = g.agg(F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("tp"),
              F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias("fp"),
              F.coalesce(F.sum(F.when(~above, F.col("pos"))), F.lit(0)).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    thr = c.select(F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1_score"),
                   F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
                   F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"))
    return combine_rows(curve, thr).select("roc_auc", "pr_auc", "f1_score", "precision", "recall",
                                       *[f"recall_at_{int(round(lv * 100))}_precision" for lv in levels])


# M14 ---------------------------------------------------------------------------
def error_analysis(scored: DataFrame, label: str = "is_churned", prob: str = "churn_probability",
                   threshold: float = 0.5) -> DataFrame:
    """FP and FN counts with mean total_events, days_since_registration and %
    paid users of each (0 when empty); always two rows."""
    y = F.col(label).cast("int") == 1
    pred = F.col(prob) > threshold
    et = F.when(~y & pred, "false_positive").when(y & ~pred, "false_negative")
    agg = (scored.withColumn("error_type", et).filter(F.col("error_type").isNotNull()).groupBy("error_type")
                 .agg(F.count(F.lit(1)).alias("count"), F.avg("total_events").alias("avg_total_events"),
                      F.avg("days_since_registration").alias("avg_days_since_registration"),
                      (F.avg("current_level_paid") * 100).alias("paid_users_pct")))
    kinds = scored.sparkSession.createDataFrame([("false_positive",), ("false_negative",)], "error_type string")
    out = F.broadcast(kinds).join(agg, "error_type", "left")
    return out.select("error_type", F.coalesce("count", F.lit(0)).alias("count"),
                      *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
                        ("avg_total_events", "avg_days_since_registration", "paid_users_pct")])


# D13 ---------------------------------------------------------------------------
def log_performance(df: DataFrame, label: str = "label", prob: str = "score", threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, f1 = 2PR/max(P+R, 1e-8), actual and
    predicted rates, mean probability; prediction is ``> threshold``."""
    y = F.col(label).cast("int")
    pred = (F.col(prob) > threshold).cast("int")
    c = df.agg(F.count(F.lit(1)).alias("num_predictions"), F.sum((y == pred).cast("int")).alias("_correct"),
               F.sum(y * pred).alias("_tp"), F.sum(pred).alias("_pp"), F.sum(y).alias("_ap"),
               F.avg(F.col(prob)).alias("avg_churn_probability"))
    n = F.col("num_predictions")
    prec = F.col("_tp") / F.greatest(F.col("_pp"), F.lit(1))
    rec = F.col("_tp") / F.greatest(F.col("_ap"), F.lit(1))
    return c.select("num_predictions", (F.col("_correct") / n).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"),
                    (2 * prec * rec / F.greatest(prec + rec, F.lit(1e-8))).alias("f1_score"),
                    (F.col("_ap") / n).alias("churn_rate"), (F.col("_pp") / n).alias("prediction_rate"),
                    "avg_churn_probability")
