"""Structured Streaming re-aims of the batch increments.

* T1 ``incremental_stream``: new canonical events since the last run, from a
  file source with a checkpoint (files, not a ts high-watermark, so late rows
  are kept), de-duplicated by event_id against the sink.
* T2 ``rate_stream``: events and a mergeable sketch of the users per tumbling day, every day.
* T3 ``score_stream``: micro-batches of feature rows scored and summarised
  with ``foreachBatch``.

All run with ``trigger(availableNow=True)``: process what is there, stop.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators import scoring as SC
from ..operators.dataset import state_one_hot
from ..sources import registry as REG
from ..sources.canonical import matching_paths, path_exists

CANONICAL_STREAM_SCHEMA = T.StructType(S.EVENT_SCHEMA.fields + [T.StructField("event_date", T.DateType())])


def read_event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(CANONICAL_STREAM_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


FEW_IDS = 1000       # ids of a batch up to which the sink is asked for these ids only
USERS_LGK = 14       # 2**14 registers: standard error 0.8 %


# T1 ----------------------------------------------------------------------------
def incremental_stream(spark: SparkSession, source: str, sink: str, checkpoint: str) -> None:
    """Append the events of new files that the sink does not have yet, however late they are.

    No watermark decides what is new: each micro-batch is anti-joined on
    event_id with what the sink has of exactly the batch's dates
    (:func:`earlier_ids`).  A batch owns the partition ``batch_id``, so writing
    it again after a failure replaces it.  The sink's files carry Parquet Bloom
    filters of event_id; a batch of few events asks for its ids, and row groups
    that cannot hold one are not read.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        new = batch.dropDuplicates(["event_id"])
        dates = [r[0] for r in batch.select("event_date").distinct().collect()]
        earlier = earlier_ids(spark, sink, dates, epoch)
        if earlier is not None:
            ids = [r[0] for r in new.select("event_id").limit(FEW_IDS + 1).collect()]
            new = new.join(earlier.filter(F.col("event_id").isin(ids)) if len(ids) <= FEW_IDS else earlier, "event_id", "left_anti")
        (new.select(*CANONICAL_STREAM_SCHEMA.fieldNames()).write.mode("overwrite").partitionBy("event_date")
            .option("parquet.bloom.filter.enabled#event_id", "true").parquet(f"{sink}/batch_id={epoch}"))
    q = (read_event_stream(spark, source).writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def earlier_ids(spark: SparkSession, sink: str, dates: list, epoch: int) -> DataFrame | None:
    """event_id of the sink's rows of ``dates`` from other batches; no other date's folder is opened."""
    names = [f"event_date={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in dates]
    paths = [p for n in names for p in matching_paths(spark, f"{sink}/batch_id=*/{n}") if f"/batch_id={epoch}/" not in p]
    return spark.read.schema("event_id long").parquet(*paths) if paths else None


# T2 ----------------------------------------------------------------------------
def rate_stream(spark: SparkSession, source: str, sink: str, checkpoint: str) -> None:
    """Events and a sketch of the distinct users of every day, open ones included.

    The state is one row per calendar day with a HyperLogLog sketch of bounded
    size, so it needs no watermark: late events update their day.  Sketches of
    days merge, so distinct users of any set of days come from the day rows
    (``drift.event_rate_proxy_from_rates``).  Each micro-batch writes the days it
    changed under its own ``batch_id``; :func:`read_rates` takes the newest of each.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={epoch}")
    s = (read_event_stream(spark, source)
         .groupBy(F.window("ts", "1 day").alias("w"))
         .agg(F.count(F.lit(1)).alias("events"), F.hll_sketch_agg("userId", USERS_LGK).alias("users"))
         .select(F.col("w.start").alias("day_start"), F.col("w.end").alias("day_end"), "events", "users"))
    q = (s.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()


def read_rates(spark: SparkSession, sink: str) -> DataFrame:
    """day_start, day_end, events, approx_users and the sketch users: the newest row of every day."""
    r = spark.read.parquet(sink)
    newest = F.max_by(F.struct("day_end", "events", "users"), "batch_id").alias("r")
    return r.groupBy("day_start").agg(newest).select(
        "day_start", "r.day_end", "r.events", F.hll_sketch_estimate("r.users").alias("approx_users"), "r.users")


# T3 ----------------------------------------------------------------------------
def score_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, feature_list: list[str] | None = None,
                 model=None, max_files: int | None = 1, registry: str | None = None) -> None:
    """Score each micro-batch of feature rows; scores and a summary per batch (written again, not twice, on a retry).

    With ``registry`` each batch resolves the model for itself (S8), so a model
    deployed between two batches is used from then on.  What a batch resolved is
    written before its scores; the batch run again, after a failure or over a
    new checkpoint, takes the same version.  ``model_path`` stands beside the
    scores (null for a model that was passed in).
    """
    def resolved(epoch: int):
        from pyspark.ml import PipelineModel
        place = f"{sink}/versions/batch_id={epoch}"
        if path_exists(spark, f"{place}/_SUCCESS"):
            kept = spark.read.schema("model_path string, feature_list array<string>").parquet(place).first()
            return PipelineModel.load(kept["model_path"]), kept["feature_list"], kept["model_path"]
        found, row = REG.load_latest_model(spark, registry, PipelineModel.load)
        if found is None:
            raise RuntimeError(f"no usable model in {registry}")
        (spark.createDataFrame([(row["model_path"], row["feature_list"])], "model_path string, feature_list array<string>")
         .write.mode("overwrite").parquet(place))
        return found, row["feature_list"], row["model_path"]

    def handle(batch: DataFrame, epoch: int) -> None:
        m, feats, version = resolved(epoch) if registry else (model, feature_list, None)
        if registry:
            batch = state_one_hot(batch, [c[len("state_"):] for c in feats if c.startswith("state_")])
        scored = SC.score_users(batch, feats, m).withColumn("model_path", F.lit(version).cast("string"))
        scored.write.mode("overwrite").parquet(f"{sink}/scores/batch_id={epoch}")
        SC.score_summary(scored).write.mode("overwrite").parquet(f"{sink}/summary/batch_id={epoch}")
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    q = (r.parquet(source).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
