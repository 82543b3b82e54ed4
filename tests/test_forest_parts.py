"""A forest over many rows is fitted, kept and scored in parts, and is whole."""
import functools
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ebbline import schema as S
from ebbline.plans import forest as FO
from ebbline.plans import training as TR

VA = dict(inputCols=["a", "b"], outputCol="features")


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("userId"), (F.rand(1) < 0.4).cast("double").alias("label"),
                                 F.lit(1.0).alias("weight"), F.round(F.randn(2), 1).alias("a"), F.round(F.randn(3), 1).alias("b"))
    return VectorAssembler(**VA).transform(df).localCheckpoint()


@pytest.fixture(scope="module")
def parted(rows):
    return FO.fit_forest(TR.make_estimator("random_forest", 400).setNumTrees(7), rows, 400, tree_rows=800)


def column(df, name):
    return np.array([r[0].toArray() for r in df.orderBy(F.col("userId").cast("int")).select(name).collect()])


@pytest.mark.parametrize("trees, n", [(100, 0), (100, 300), (100, 20_000), (100, 20_001), (100, 442_000), (7, 10 ** 9)])
def test_no_tree_is_left_out_and_no_part_is_too_large(trees, n):
    sizes = FO.part_sizes(trees, n)
    assert sum(sizes) == trees and min(sizes) >= 1
    assert max(sizes) == 1 or max(sizes) * n <= FO.TREE_ROWS
    assert len(sizes) == 1 or n * trees > FO.TREE_ROWS


def test_few_rows_give_the_model_of_one_fit(rows):
    est = TR.make_estimator("random_forest", 400).setNumTrees(3)
    one = FO.fit_forest(est, rows, 400)
    assert isinstance(one, RandomForestClassificationModel)
    assert one.toDebugString.split("\n")[1:] == est.fit(rows).toDebugString.split("\n")[1:]


def test_votes_and_importances_are_those_of_all_trees(rows, parted):
    assert parted.sizes == [2, 2, 2, 1] and parted.getNumTrees == 7
    raw, importances, seen = 0, 0, set()
    for part in parted.parts():
        raw = raw + column(part.transform(rows), "rawPrediction")
        importances = importances + sum(t.featureImportances.toArray() for t in part.trees)
        seen |= {t.toDebugString.split("\n", 1)[1] for t in part.trees}
    assert len(seen) == 7                                                       # each part draws for itself
    out = parted.transform(rows)
    assert out.columns == [*rows.columns, "rawPrediction", "probability", "prediction"] and out.count() == 400
    assert np.allclose(column(out, "rawPrediction"), raw) and np.allclose(column(out, "probability"), raw / 7)
    assert [r[0] for r in out.orderBy(F.col("userId").cast("int")).select("prediction").collect()] == list(raw.argmax(1))
    assert np.allclose(parted.featureImportances.toArray(), importances / importances.sum())


def test_saved_in_a_pipeline_and_loaded_it_scores_the_same(rows, parted):
    path = f"{tempfile.mkdtemp(prefix='ebb-forest-')}/model"
    pipe = PipelineModel(stages=[VectorAssembler(**VA), parted])
    for _ in range(2):
        pipe.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[1].featureImportances == parted.featureImportances and loaded.stages[1].sizes == parted.sizes
    assert (column(loaded.transform(rows.drop("features")), "probability") == column(parted.transform(rows), "probability")).all()


def test_training_never_holds_more_than_a_part_on_the_driver(spark, monkeypatch):
    """100 trees in all, never more than tree rows allow at once, by train_and_compare and what reads its forest."""
    df = spark.range(300).select(
        F.col("id").cast("string").alias("userId"), (F.rand(4) < 0.4).alias("is_churned"), F.lit("CA").alias("location_state"),
        *[(F.randn(i) if i < 5 else F.lit(0.0)).alias(c) for i, c in enumerate(S.NUMERIC_FEATURES) if c != "days_since_registration"],
        (F.col("id") % 50).cast("double").alias("days_since_registration")).localCheckpoint()
    fits, fit = [], RandomForestClassifier.fit

    @functools.wraps(fit)
    def noted(self, train):
        fits.append((self.getNumTrees(), train.count(), self.getMaxDepth(), self.getSeed()))
        return fit(self, train)
    monkeypatch.setattr(RandomForestClassifier, "fit", noted)
    monkeypatch.setattr(FO, "TREE_ROWS", 10_000)
    metrics, fitted, prep = TR.train_and_compare(df, models=["random_forest"])
    n = prep.train.count()
    assert sum(f[0] for f in fits) == 100 and len({f[3] for f in fits}) == len(fits) > 1
    assert all(f[0] * f[1] <= 10_000 and f[1] == n and f[2] == 30 for f in fits)
    forest, test = fitted["random_forest"], prep.test.count()
    scored = prep.scored["random_forest"]
    assert scored.count() == test and 0 <= metrics.first()["pr_auc"] <= 1
    again = TR.error_analysis_for(forest, prep).orderBy("error_type").collect()
    assert TR.error_analysis_for(forest, prep, scored).orderBy("error_type").collect() == again
    assert sum(r["count"] for r in again) == scored.filter((F.col("score") > 0.5) != (F.col("label") == 1)).count() > 0
    assert abs(sum(r["importance"] for r in TR.feature_importance(spark, forest, prep.columns).collect()) - 1) < 1e-9
