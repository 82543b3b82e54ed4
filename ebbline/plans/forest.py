"""A random forest of deep trees whose driver memory does not grow with trees times rows.

Spark grows all trees of a fit together and holds every node of them on the
driver, and scoring sends all of them at once; deep trees over rows that differ
have a node for every few rows.  Trees of a forest do not depend on each
other, so over many rows they are fitted in parts of a few trees: each part is
saved to the shared folder and let go before the next one.  Scoring loads one
part at a time, too, and adds up its votes; what comes out is the vote of all
trees, as in one model.
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged, staged_path

TREE_ROWS = 2_000_000       # trees x training rows of one part: about 0.4 million nodes, some 0.3 GB on the driver
SEED_STEP = 1_000_003       # a fit also adds its partitions' numbers to the seed


def part_sizes(trees: int, rows: int, tree_rows: int | None = None) -> list[int]:
    """Trees of each part: one part while trees x rows fit, else as few and as even as they can be."""
    most = max(1, min(trees, (tree_rows or TREE_ROWS) // max(rows, 1)))
    parts = math.ceil(trees / most)
    return [trees // parts + (i < trees % parts) for i in range(parts)]


def fit_forest(est: RandomForestClassifier, train: DataFrame, rows: int, tree_rows: int | None = None):
    """All trees of ``est`` over all of ``train`` (``rows`` rows): one Spark model, or a :class:`ForestInParts`.

    A part differs from the others by its seed only; the first one has the estimator's.
    """
    sizes = part_sizes(est.getNumTrees(), rows, tree_rows)
    if len(sizes) == 1:
        return est.fit(train)
    folder, first, total = staged_path(train.sparkSession), 0, 0.0
    for i, trees in enumerate(sizes):
        part = est.copy({est.numTrees: trees, est.seed: est.getSeed() + SEED_STEP * first}).fit(train)
        part.write().save(_part_path(folder, i))
        # a model's importances are the mean of its trees that have a split
        total = total + part.featureImportances.toArray() * sum(t.numNodes > 1 for t in part.trees)
        first += trees
        del part        # or it would be held while the next one grows
    norm = float(np.sum(total))
    return ForestInParts(folder, sizes, [float(v) / (norm or 1.0) for v in total])


def _part_path(folder: str, i: int) -> str:
    return f"{folder}/parts/{i:03d}"


class ForestInParts(Model, MLReadable, MLWritable):
    """A fitted forest whose parts lie in a folder.  ``transform`` works at once, part by part, on a batch frame."""

    def __init__(self, folder: str, sizes: list[int], importances: list[float]):
        super().__init__()
        self.folder, self.sizes = folder, list(sizes)
        self.featureImportances = DenseVector(importances)

    @property
    def getNumTrees(self) -> int:
        return sum(self.sizes)

    def parts(self):
        """The parts, loaded one after the other."""
        for i in range(len(self.sizes)):
            yield RandomForestClassificationModel.load(_part_path(self.folder, i))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        rows = staged(dataset.withColumn("_row", F.monotonically_increasing_id()))
        folder = staged_path(spark)
        for i, part in enumerate(self.parts()):
            votes = vector_to_array("rawPrediction").alias("votes")
            part.transform(rows.select("_row", part.getFeaturesCol())).select("_row", votes).write.parquet(f"{folder}/part={i}")
            del part
        each = spark.read.schema("_row long, votes array<double>, part int").parquet(folder)
        # added in the order of the parts: a sum of doubles must not depend on which task was first
        each = each.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("part", "votes"))).alias("each"))
        add = lambda a, b: F.zip_with(a, b["votes"], lambda x, y: x + y)
        all_ = F.aggregate(F.slice("each", 2, len(self.sizes)), F.col("each")[0]["votes"], add)
        votes, sum_ = F.col("_votes"), F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        return (rows.join(each.select("_row", all_.alias("_votes")), "_row").select(
            *[F.col(f"`{c}`") for c in dataset.columns],
            array_to_vector(votes).alias("rawPrediction"),
            array_to_vector(F.transform(votes, lambda v: F.when(sum_ == 0, v).otherwise(v / sum_))).alias("probability"),
            (F.array_position(votes, F.array_max(votes)) - 1).cast("double").alias("prediction")))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestInParts):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "sizes": m.sizes, "importances": m.featureImportances.toArray().tolist()})
        for i, part in enumerate(m.parts()):
            part.write().save(_part_path(path, i))
            del part


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestInParts:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return ForestInParts(path, meta["sizes"], meta["importances"])._resetUid(meta["uid"])
