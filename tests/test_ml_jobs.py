import tempfile

import pytest
from pyspark.sql import functions as F

from ebbline import schema as S
from ebbline.catalog import CUTOFF_A
from ebbline.operators import dataset as DS
from ebbline.operators import features as X
from ebbline.operators import labels as L
from ebbline.operators.prep import common_columns, contract_check
from ebbline.plans import jobs as J
from ebbline.plans import training as TR
from ebbline.sources.adapters import load_activity_events

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model_df(spark):
    ev = load_activity_events(spark, SF)
    return X.features_with_labels(X.feature_matrix(ev, CUTOFF_A), L.churn_labels(ev, 1)).checkpoint()


def test_common_columns_sorted(spark):
    a = spark.createDataFrame([(1, 2, 3)], "z int, a int, m int")
    b = spark.createDataFrame([(1, 2)], "m int, z int")
    assert common_columns(a, b) == ["m", "z"]


def test_contract_check_flags_missing(spark):
    df = spark.createDataFrame([("u", None, 1.0), (None, 2.0, 3.0)], "userId string, days_since_registration double, x double")
    rows = {r.x: r for r in contract_check(df, [("userId", "string"), ("days_since_registration", "double"),
                                                ("absent", "double")]).collect()}
    assert rows[1.0].missing_fields == ["days_since_registration", "absent"] and not rows[1.0].valid
    assert rows[3.0].missing_fields == ["userId", "absent"]


def test_expanding_folds_match_forward_split_formula(spark, model_df):
    d = DS.expanding_folds(model_df).select("idx", "test_fold").collect()
    n = len(d)
    ts = n // 4
    for r in d:
        start0 = n - 3 * ts
        expect = (r.idx - start0) // ts if r.idx >= start0 else None
        assert r.test_fold == expect
    assert sorted(r.idx for r in d) == list(range(n))


def test_time_split_quantile(spark, model_df):
    import numpy as np
    rows = DS.time_based_split(model_df).select("days_since_registration", "split").collect()
    q = float(np.quantile([r[0] for r in rows], 0.8))          # linear interpolation, as the reference
    assert all((r.split == "train") == (r.days_since_registration <= q) for r in rows)
    assert any(r.split == "test" for r in rows)


def test_train_save_load_score_roundtrip(spark, model_df):
    metrics, fitted, prep = TR.train_and_compare(model_df, models=["logistic_regression"])
    m = metrics.first()
    assert 0.0 <= m.pr_auc <= 1.0 and 0.0 <= m.roc_auc <= 1.0
    paths = J.default_paths(tempfile.mkdtemp(prefix="ebb-jobs-"))
    from ebbline.sources import registry as REG
    pipe = TR.as_pipeline(fitted["logistic_regression"], prep)
    REG.save_model(pipe, paths["registry"], paths["models"], m.asDict(), "logistic_regression", prep.columns, None, True)
    ev = load_activity_events(spark, SF)
    scores, summary = J.score_with_latest_model(ev, paths, CUTOFF_A, labels=L.churn_labels(ev, 1))
    direct = TR.probability(fitted["logistic_regression"].transform(prep.test)).select("userId", "score")
    j = scores.join(direct, "userId")
    assert j.count() == prep.test.count()
    assert j.filter(F.abs(F.col("score") - F.col("churn_probability")) > 1e-9).count() == 0
    assert summary.first().total_users == model_df.count()
    assert REG.read_perf_log(spark, paths["perf_log"]).count() == 1


def test_feature_contract_names():
    assert len(S.NUMERIC_FEATURES) == 64 and S.FEATURE_COLUMNS[-1] == "location_state"


def test_forest_keeps_the_node_of_every_row(spark):
    """No pass walks the trees from their roots, and the trees are the ones grown without that."""
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(300).select((F.rand(1) < 0.4).cast("double").alias("label"), F.lit(1.0).alias("weight"),
                                 F.randn(2).alias("a"), F.randn(3).alias("b"))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).localCheckpoint()
    est = TR.make_estimator("random_forest", 300)
    assert est.getCacheNodeIds() and est.getNumTrees() == 100 and est.getMaxDepth() == 30
    few = est.setNumTrees(5)
    assert few.fit(df).toDebugString.split("\n")[1:] == few.copy().setCacheNodeIds(False).fit(df).toDebugString.split("\n")[1:]
