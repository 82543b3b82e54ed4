"""Sharding by jump consistent hashing.

A stable 64-bit key of each row is mapped to one of ``shards`` shards by the
jump consistent hash (Lamping and Veach, 2014), which needs no ring table:
going from n to n + 1 shards moves only about 1 / (n + 1) of the keys, all of
them into the new shard.

Every row also gets a gapless slot in its shard.  Rows are numbered per task
and shard while they are hashed, the numbered rows are written once, and the
tasks' counts are summed into offsets; so no shard is ever gathered in one
task, however large it is.

Defined cases: a null text has size 8 and crc 0; a null id is a key like any
other; rows of one id, repeated or not, go to one shard and get different slots.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

SHARDS, ROW_OVERHEAD = 24, 8


def jump_hash(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key: leaps ahead with probability (b + 1) / (j + 1) until past the last shard."""
    state = key.astype(np.uint64)
    current = np.zeros(len(state), np.int64)
    leap = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        current[moving] = leap[moving]
        with np.errstate(over="ignore"):
            state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        leap[moving] = np.floor((current[moving] + 1) * (2.0 ** 31 / draw)).astype(np.int64)
        moving = moving[leap[moving] < shards]
    return current


def numbered(df: DataFrame, group_column: str, add) -> DataFrame:
    """Rows of ``df`` through ``add`` (a function of a record batch), with the task and a running number.

    Adds _w_task and _w_nth, the row's number within its task and group.  The
    caller stages the result before using them, so that both are facts of a
    table and not of a run.
    """
    schema, fn = add
    full = T.StructType([*schema.fields, T.StructField("_w_task", T.IntegerType()), T.StructField("_w_nth", T.LongType())])

    def run(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            b = fn(b)
            group = np.asarray(b.column(b.schema.get_field_index(group_column)))
            order = np.argsort(group, kind="stable")
            values, first, count = np.unique(group[order], return_index=True, return_counts=True)
            nth = np.empty(len(group), np.int64)
            for v, f, c in zip(values.tolist(), first, count, strict=True):
                nth[order[f:f + c]] = seen.get(v, 0) + np.arange(c)
                seen[v] = seen.get(v, 0) + int(c)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(group), task, np.int32)), pa.array(nth)],
                                             names=[*b.schema.names, "_w_task", "_w_nth"])

    return df.mapInArrow(run, full)


def with_rank(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Gapless number from 0 in each group, from the staged columns of ``numbered``.

    Only the tasks' counts (one row for each group and task) are sorted.
    """
    counts = rows.groupBy(group, "_w_task").agg(F.count(F.lit(1)).alias("_w_n"))
    before = Window.partitionBy(group).orderBy("_w_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_w_task", F.coalesce(F.sum("_w_n").over(before), F.lit(0)).alias("_w_before"))
    return (rows.join(offsets, [group, "_w_task"]).withColumn(name, F.col("_w_before") + F.col("_w_nth"))
            .drop("_w_task", "_w_nth", "_w_before"))


def shard_rows(df: DataFrame, key: Column, shards: int = SHARDS) -> DataFrame:
    """All columns of ``df`` with shard, grown_shard (with one shard more) and slot; such columns are replaced."""
    df = df.drop("shard", "grown_shard", "slot").withColumn("_w_key", F.xxhash64(key))
    schema = T.StructType([f for f in df.schema.fields if f.name != "_w_key"]
                          + [T.StructField("shard", T.IntegerType()), T.StructField("grown_shard", T.IntegerType())])

    def place(b: pa.RecordBatch) -> pa.RecordBatch:
        at = b.schema.get_field_index("_w_key")
        k = np.asarray(b.column(at)).astype(np.int64).view(np.uint64)
        cols = [c for i, c in enumerate(b.columns) if i != at]
        names = [n for n in b.schema.names if n != "_w_key"]
        return pa.RecordBatch.from_arrays([*cols, pa.array(jump_hash(k, shards).astype(np.int32)),
                                           pa.array(jump_hash(k, shards + 1).astype(np.int32))],
                                          names=[*names, "shard", "grown_shard"])

    return with_rank(staged(numbered(df, "shard", (schema, place)), "shards"), "shard", "slot")


def query(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(raw).cast("long") + ROW_OVERHEAD).alias("size"),
                       F.crc32(raw.cast("binary")).alias("text_crc32"))
    return shard_rows(slim, F.col("doc_id"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
