"""Registered queries of the training-data operators, each over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (best_fit, dart_minhash, decontaminate, fm_phrases, hilbert_kmeans, html_paths, jump_shard, language_gru,
               quality_cnn, quality_llr, rlz_spans, secret_index, toxicity)
from .common import table


def over(fn: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*(table(spark, sf_dir, t) for t in tables))
    run.__name__, run.__doc__ = fn.__module__.rsplit(".", 1)[-1], fn.__doc__
    return run


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``; the packed pieces of what they keep."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_cnn": over(quality_cnn.query, "documents", "labels"),
    "op2_quality_llr": over(quality_llr.query, "documents", "labels"),
    "op3_decontaminate": over(decontaminate.query, "documents", "benchmark"),
    "op4_dart_minhash": over(dart_minhash.query, "documents"),
    "op5_best_fit": over(best_fit.query, "documents"),
    "op6_jump_shard": over(jump_shard.query, "documents"),
    "op7_toxicity": over(toxicity.query, "documents", "labels"),
    "op8_language_gru": over(language_gru.query, "documents"),
    "op9_secret_index": over(secret_index.query, "documents"),
    "op10_html_paths": over(html_paths.query, "pages"),
    "op11_fm_phrases": over(fm_phrases.query, "documents"),
    "op12_rlz_spans": over(rlz_spans.query, "documents"),
    "op13_hilbert_kmeans": over(hilbert_kmeans.query, "embeddings"),
    "pipeline": pipeline,
}
# The others have learned models, hashes or tokenizers that SQL lacks.
ORACLE: dict[str, str] = {"op3_decontaminate": decontaminate.ORACLE, "op11_fm_phrases": fm_phrases.ORACLE,
                          "op12_rlz_spans": rlz_spans.ORACLE, "op13_hilbert_kmeans": hilbert_kmeans.ORACLE}
