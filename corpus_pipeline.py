"""From raw documents to packed training sequences, as a chain of distributed stages.

Each stage takes all rows that the one before it kept, is written as Parquet
and read again by the next one; its decisions take effect on the rows:

1. quality_classifier    rows that the classifier rejects go
2. near_dedup            of each near-duplicate class one row stays
3. decontamination       rows in which a benchmark window occurs go
4. secret_scan           secrets are masked in the text, all rows stay
5. packing               every document's pieces get a place in a sequence

All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbline.llm import best_fit, dart_minhash, decontaminate, quality_cnn, secret_index
from ebbline.llm.common import prepare, staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_cnn.quality_scores(docs, model)
    return scored.filter("quality_predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dart_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_index.mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return best_fit.query(docs)


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("packing", packing)]

# A trained classifier, signatures and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
