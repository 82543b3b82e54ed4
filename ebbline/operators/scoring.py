"""Batch scoring (D1, D2) and the fixed linear model used by the oracles.

A trained ``PipelineModel`` scores with ``transform`` (see
:mod:`ebbline.plans.training`); ``fixed_linear_score`` is a literal model -
``sigmoid(intercept + sum w_i * x_i)`` - so scoring, metrics and drift can
be checked against SQL without a fitted model.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import risk_level, sigmoid
from .prep import align_to_contract

# A literal model over contract features (weights chosen for the fixtures,
# not fitted): churn risk grows with idleness, downgrades and decline.
FIXED_MODEL = {
    "intercept": -2.0,
    "days_since_last_event": 0.35,
    "downgrade_events": 0.9,
    "activity_decline_7d": 1.2,
    "songs_ratio": -1.5,
    "current_level_paid": 0.4,
}


def fixed_linear_score(df: DataFrame, model: dict | None = None, out: str = "churn_probability") -> DataFrame:
    m = dict(model or FIXED_MODEL)
    b = float(m.pop("intercept", 0.0))
    z = F.lit(b)
    for c, w in m.items():
        z = z + F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.withColumn(out, sigmoid(z))


# D1 ----------------------------------------------------------------------------
def score_users(features: DataFrame, feature_list: list[str], model=None, scored_at=None) -> DataFrame:
    """Align to the model's feature list (F7), score, and classify.

    ``model`` is a fitted ``pyspark.ml`` model (probability vector column) or
    a dict for :func:`fixed_linear_score`; prediction is ``p >= 0.5``.
    """
    x = align_to_contract(features, feature_list)
    if model is None or isinstance(model, dict):
        s = fixed_linear_score(x, model)
    elif hasattr(model, "stages"):      # a PipelineModel carries its own feature transform
        from pyspark.ml.functions import vector_to_array
        s = model.transform(x).withColumn("churn_probability", vector_to_array("probability").getItem(1))
    else:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array
        va = VectorAssembler(inputCols=list(feature_list), outputCol="features")
        s = model.transform(va.transform(x)).withColumn(
            "churn_probability", vector_to_array("probability").getItem(1))
    ts = F.lit(scored_at).cast("timestamp") if scored_at is not None else F.current_timestamp()
    return s.select("userId", "churn_probability",
                    (F.col("churn_probability") >= 0.5).alias("churn_prediction"),
                    risk_level("churn_probability").alias("risk_level"),
                    ts.alias("prediction_timestamp"))


# D2 ----------------------------------------------------------------------------
def score_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("total_users"),
                      F.count_if(F.col("risk_level") == "high").alias("high_risk_users"),
                      F.count_if(F.col("risk_level") == "medium").alias("medium_risk_users"),
                      F.count_if(F.col("risk_level") == "low").alias("low_risk_users"),
                      F.avg("churn_probability").alias("avg_churn_probability"),
                      F.max("churn_probability").alias("max_churn_probability"),
                      F.min("churn_probability").alias("min_churn_probability"))
