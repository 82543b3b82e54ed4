"""Model training, comparison and validation (M5-M8, M13-M16) with pyspark.ml.

The loops here run over the three estimators and the three folds - never
over users or rows.  Scaling is the population-std standardisation fitted
on the training part (M4, as the reference does); the estimators then run
with ``standardization=False``.  A forest over many rows is fitted and kept
in parts (:mod:`ebbline.plans.forest`).
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dataset as DS
from ..operators import evaluate as V
from ..session import staged
from .forest import fit_forest

MODEL_NAMES = ["gradient_boosting", "random_forest", "logistic_regression"]
META = ["total_events", "days_since_registration", "current_level_paid"]     # kept beside the features for M14


def make_estimator(name: str, n_train: int, max_depth_rf: int = 30):
    """Reference hyper-parameters re-expressed for pyspark.ml.

    LR: L2, C = 1 -> regParam = 1 / sum(weights) (= 1/n with balanced
    weights), max 1000 iterations.  RF: 100 trees, sqrt features, deep trees
    (Spark caps depth at 30), balanced weights, seed 42; every row keeps its
    node of each tree, so that a pass over a group of nodes neither sends the
    trees grown so far to the tasks nor walks them from the root (the forest is
    the same).  GBT: 100 rounds, depth 3, step 0.1, seed 42, unweighted.
    """
    if name == "logistic_regression":
        return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=1000,
                                  regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False)
    if name == "random_forest":
        return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=100,
                                      featureSubsetStrategy="sqrt", maxDepth=max_depth_rf, seed=42, cacheNodeIds=True)
    if name == "gradient_boosting":
        return GBTClassifier(featuresCol="features", labelCol="label", maxIter=100, maxDepth=3, stepSize=0.1,
                             seed=42)
    raise ValueError(name)


@dataclass
class PreparedData:
    train: DataFrame
    test: DataFrame
    columns: list[str]
    scaler: dict = field(default_factory=dict)
    scored: dict = field(default_factory=dict)      # the test rows as each fitted model scored them, by its name


def prepare(model_df: DataFrame, test_size: float = 0.2) -> PreparedData:
    """M1 split -> M2 common state flags -> F6 projection -> M3 weights -> M4 scaling.

    The labelled matrix (one row per user) feeds several actions - split
    quantile, state list, scaler fit, every model fit - so it and the
    projected train/test sets are checkpointed once instead of re-running
    the feature plan for each.
    """
    model_df = staged(model_df)
    d = DS.time_based_split(model_df, test_size).withColumn("label", F.col("is_churned").cast("double"))
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    states = DS.state_list(train, test)
    cols = DS.model_columns(model_df, states)
    train = DS.state_one_hot(train, states)
    test = DS.state_one_hot(test, states)
    params = DS.collect_scaler(DS.scaler_params(train, cols))
    meta = [F.col(c).alias(f"meta_{c}") for c in META]
    keep = ["userId", "label"] + [f"meta_{c}" for c in META]

    def project(df):
        raw = df.select("userId", "label", *meta,
                        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x_{c}") for c in cols])
        scaled = raw.select(*keep, *[((F.col(f"x_{c}") - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
                                     for c in cols])
        return VectorAssembler(inputCols=cols, outputCol="features").transform(scaled)
    tr = staged(DS.balanced_weights(project(train), "label"))
    te = staged(project(test))
    return PreparedData(tr, te, cols, params)


def as_pipeline(model, prep: PreparedData):
    """Scoring pipeline: fitted scaling (an SQLTransformer with the train
    mean/std as literals) -> VectorAssembler -> fitted classifier.  Saved and
    loaded as one ``PipelineModel``, so scoring applies the training transform."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    cols = prep.columns
    sel = ", ".join(f"(coalesce(CAST(`{c}` AS DOUBLE), 0.0) - {prep.scaler[c][0]!r}) / {prep.scaler[c][1]!r} AS `{c}`"
                    for c in cols)
    scaler = SQLTransformer(statement=f"SELECT userId, {sel} FROM __THIS__")
    assembler = VectorAssembler(inputCols=cols, outputCol="features")
    return PipelineModel(stages=[scaler, assembler, model])


def probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("score", vector_to_array("probability").getItem(1))


# M8 ----------------------------------------------------------------------------
def feature_importance(spark: SparkSession, model, columns: list[str]) -> DataFrame:
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    else:
        vals = [abs(float(v)) for v in model.coefficients.toArray().tolist()]
    return spark.createDataFrame(list(zip(columns, [float(v) for v in vals])), "feature string, importance double")


# M13 ---------------------------------------------------------------------------
def train_and_compare(model_df: DataFrame, models=None, max_depth_rf: int = 30):
    """Fit each model on train, evaluate on test; returns (metrics table,
    fitted models by name, prepared data).  Best = max PR-AUC (ties: name).
    The scored test rows are written once and stay in ``prep.scored``."""
    prep = prepare(model_df)
    n_train = prep.train.count()
    rows, fitted = None, {}
    for name in models or MODEL_NAMES:
        est = make_estimator(name, n_train, max_depth_rf)
        m = fit_forest(est, prep.train, n_train) if name == "random_forest" else est.fit(prep.train)
        fitted[name] = m
        prep.scored[name] = staged(probability(m.transform(prep.test)).select(
            "userId", "label", "score", *[f"meta_{c}" for c in META]))
        rep = V.classification_report(prep.scored[name]).withColumn("model", F.lit(name))
        rows = rep if rows is None else rows.unionByName(rep)
    metrics = rows.select("model", "pr_auc", "roc_auc", "f1_score", "precision", "recall",
                          "recall_at_90_precision", "recall_at_80_precision")
    return metrics, fitted, prep


def best_model(metrics: DataFrame) -> DataFrame:
    """K6: the row with the highest PR-AUC (ties: model name)."""
    return metrics.orderBy(F.col("pr_auc").desc_nulls_last(), F.col("model")).limit(1)


# M14 with a fitted model ------------------------------------------------------------
def error_analysis_for(model, prep: PreparedData, scored: DataFrame | None = None) -> DataFrame:
    """FP/FN analysis of the test rows; ``scored`` has them if the model scored them before (``prep.scored``)."""
    pred = scored if scored is not None else probability(model.transform(prep.test))
    s = pred.select(F.col("label").alias("is_churned"), F.col("score").alias("churn_probability"),
                    *[F.col(f"meta_{c}").alias(c) for c in META])
    return V.error_analysis(s)


# M15 ---------------------------------------------------------------------------
def temporal_validation(model_df: DataFrame, n_splits: int = 3, threshold: float = 0.99, min_rows: int = 50):
    """Expanding forward folds (W7), balanced LR per fold (library default
    100 iterations), PR-AUC of each fold whose test part has both classes.
    Returns a one-row frame: avg_pr_auc, splits, leakage_warning.

    Unlike the reference (where a string column makes every fit fail and
    the result silently 0.0), only numeric features enter the fit.
    """
    spark = model_df.sparkSession
    model_df = staged(model_df)    # the index, the count and the folds read it
    d = DS.expanding_folds(model_df.withColumn("label", F.col("is_churned").cast("double")), n_splits)
    cols = DS.model_columns(model_df, [])
    d = d.select("label", "idx", "test_fold", "fold_start0", "test_size",
                 *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    d = staged(d)    # read once per fold: cut the ranking lineage
    n = model_df.count()
    scores = []
    for i in range(n_splits):
        start = d.select((F.col("fold_start0") + i * F.col("test_size")).alias("s")).limit(1).collect()
        if not start:
            break
        s_i = start[0]["s"]
        train = d.filter(F.col("idx") < s_i)
        test = d.filter(F.col("test_fold") == i)
        if train.select("label").distinct().count() < 2:
            continue
        params = DS.collect_scaler(DS.scaler_params(train, cols))

        def project(df):
            sc = df.select("label", *[((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c) for c in cols])
            return VectorAssembler(inputCols=cols, outputCol="features").transform(sc)
        tr = staged(DS.balanced_weights(project(train), "label"))
        m = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=100,
                               regParam=1.0 / max(tr.count(), 1), standardization=False).fit(tr)
        pred = probability(m.transform(project(test)))
        if pred.select("label").distinct().count() > 1:
            scores.append(V.pr_auc(pred.select("label", "score")).first()["pr_auc"])
    avg = float(sum(scores) / len(scores)) if scores else 0.0
    return spark.createDataFrame([(avg, len(scores), bool(n > min_rows and avg >= threshold))],
                                 "avg_pr_auc double, splits int, leakage_warning boolean")
