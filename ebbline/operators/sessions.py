"""Gap sessionisation without an order of the events.

A plain ``lag`` over ``partitionBy(user).orderBy(ts)`` puts every event of a
user into one task; a user holding a third of the log would then be one
task.  Here time is cut into chunks no longer than the gap.  Two events of a
chunk are then never more than the gap apart, so a session can only begin at a
chunk's first event and all events of a chunk have one number.  What is ordered
is one summary row (min, max, count) per key and chunk, made by a partial
aggregation, however many events a chunk holds.

Summaries are stitched by a tree: runs of ``FAN_OUT`` chunks are numbered on
their own, and one row per run is ordered per key.  Only the join of the numbers
with the events is left.  Chunks with a notable share of all events are at most
``1 / HOT_SHARE`` many, so these are broadcast and their events stay where they
are; the others are joined by (key, chunk), and none of them is large.  More than
``BROADCAST_ROWS`` of them are never broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import staged

FAN_OUT = 4096          # chunks of a run
HOT_ROWS = 100_000      # a chunk of fewer events is never hot
BROADCAST_ROWS = 100_000   # more chunks are joined by merge, however small their file
HOT_SHARE = 1e-4        # a chunk with more than this share of all events may be; hence at most 10,000 are


def chunk_summaries(df: DataFrame, key: str, ts: str, width_us: int) -> DataFrame:
    """One row per key and chunk: its number ``_chunk``, first and last time and count of events."""
    t = F.unix_micros(F.col(ts))
    return (df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .select(F.col(key).alias("_key"), t.alias("_t"), _chunk(t, width_us).alias("_chunk"))
            .groupBy("_key", "_chunk").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count(F.lit(1)).alias("_n")))


def _chunk(t, width_us: int):
    width = F.lit(width_us).cast("long")
    return ((t - F.pmod(t, width)) / width).cast("long")


def stitched(chunks: DataFrame, gap_us: int) -> DataFrame:
    """``chunks`` with ``_seq``, the 1-based number of the session that every chunk is in."""
    w_run = W.partitionBy("_key", "_run").orderBy("_chunk")
    d = (chunks.withColumn("_run", F.floor(F.col("_chunk") / F.lit(float(FAN_OUT))))
         .withColumn("_before", F.lag("_hi").over(w_run))
         .withColumn("_new", F.when(F.col("_lo") - F.col("_before") > gap_us, 1).otherwise(0))
         .withColumn("_in_run", F.sum("_new").over(w_run.rowsBetween(W.unboundedPreceding, W.currentRow))))
    w_key = W.partitionBy("_key").orderBy("_run")
    runs = (d.groupBy("_key", "_run").agg(F.min("_lo").alias("_rlo"), F.max("_hi").alias("_rhi"), F.sum("_new").alias("_breaks"))
            .withColumn("_rbefore", F.lag("_rhi").over(w_key))
            .withColumn("_first", F.when(F.col("_rbefore").isNull() | (F.col("_rlo") - F.col("_rbefore") > gap_us), 1)
                        .otherwise(0))
            .withColumn("_offset", F.sum(F.col("_first") + F.col("_breaks")).over(
                w_key.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_breaks"))
            .select("_key", "_run", "_offset"))
    return (d.join(runs, ["_key", "_run"])
            .select("_key", "_chunk", "_n", (F.col("_offset") + F.col("_in_run")).cast("long").alias("_seq")))


def gap_session_seq(df: DataFrame, key: str, ts: str = "ts", gap_seconds: int = 6 * 3600,
                    chunk_seconds: int | None = None, out: str = "session_seq", hot_rows: int = HOT_ROWS,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``out`` = 1-based session number per ``key``.

    A new session starts at a key's first event and whenever more than
    ``gap_seconds`` passed since its previous event; events of the same time
    are in the same session.  Rows whose key or time is null are kept, with a
    null number.  A chunk is as long as the gap, or ``chunk_seconds`` if that is
    shorter; the numbers do not depend on it.
    """
    gap_us = int(gap_seconds) * 1_000_000
    width_us = max(1, min(gap_us, gap_us if chunk_seconds is None else int(chunk_seconds) * 1_000_000))
    chunks = staged(stitched(chunk_summaries(df, key, ts, width_us), gap_us))
    total = chunks.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    is_hot = (F.col("_n") > hot_rows) & (F.col("_n") > F.lit(HOT_SHARE) * total)
    hot = chunks.filter(is_hot).select("_key", "_chunk", "_seq")
    d = df.withColumns({"_key": F.col(key), "_chunk": _chunk(F.unix_micros(F.col(ts)), width_us)})
    # a file of few bytes may hold millions of chunks: rows decide if a table of them may be sent to every task
    many = chunks.count() > broadcast_rows
    sized = lambda c: c.select("_key", "_chunk", "_seq").hint("merge") if many else c.select("_key", "_chunk", "_seq")
    if hot.isEmpty():
        numbered = d.join(sized(chunks), ["_key", "_chunk"], "left")
    else:
        cold = sized(chunks.filter(~is_hot))
        numbered = (d.join(F.broadcast(hot), ["_key", "_chunk"])
                    .unionByName(d.join(F.broadcast(hot), ["_key", "_chunk"], "left_anti")
                                 .join(cold, ["_key", "_chunk"], "left")))
    return numbered.withColumn(out, F.col("_seq")).drop("_key", "_chunk", "_seq")
