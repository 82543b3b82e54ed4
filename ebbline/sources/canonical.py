"""Canonical event table: written once, read by every analytic job.

An ingest job turns raw records (JSON lines or an adapter over other tables)
into the canonical schema and writes parquet partitioned by ``event_date``.
The write is rebalanced by AQE (hot days or users are split into several
tasks, small partitions merged) and each file is sorted by (userId, ts), so
readers get tight per-file ts/user statistics.  The table lives under the shared folder the cluster names in
``spark.checkpoint.dir``; it survives executor loss and cuts the lineage of
everything downstream.
"""
from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import shared_path
from . import versions


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob matches, sorted (none where nothing does)."""
    fs, p = _fs(spark, pattern)
    return sorted(str(st.getPath()) for st in fs.globStatus(p) or [])


def _fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Identity of the inputs: path, length and modification time of every file at any depth."""
    h = hashlib.sha1()
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            files, found = fs.listFiles(p, True), []
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
            h.update("\n".join([path, *sorted(found)]).encode())
        else:
            h.update(f"{path}|missing".encode())
    return h.hexdigest()[:16]


def write_events(df: DataFrame, path: str, num_partitions: int | None = None, granularity: str = "day") -> None:
    """Write canonical events partitioned by ``event_date`` to a new path (atomic: temp + rename).

    A table that is there already is not touched: ``publish_events`` writes another version of it.

    ``granularity`` 'day' stores the event's date, 'month' the first day of
    its month (for sparse logs, so partitions do not shrink to a few rows).
    Either way ``event_date <= to_date(ts)`` holds, which is all the pruning
    predicates rely on.

    The REBALANCE hint hash-distributes rows by ``event_date`` and lets AQE
    split oversized partitions (a hot day, a hot user's day) and coalesce
    small ones to the advisory size - no sampling pass, nothing cached.
    Rows are sorted by (event_date, userId, ts, event_id) inside each file.
    ``num_partitions`` is accepted for callers that pin the file count.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"{path} is there; publish_events writes another version of a table")
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
    part = F.to_date("ts") if granularity == "day" else F.trunc(F.to_date("ts"), "month")
    out = df.select(*S.EVENT_SCHEMA.fieldNames()).withColumn("event_date", part)
    out = out.repartition(num_partitions, "event_date") if num_partitions else out.hint("rebalance", "event_date")
    (out.sortWithinPartitions("event_date", "userId", "ts", "event_id")
        .write.mode("overwrite").partitionBy("event_date").parquet(tmp))
    fs, src = _fs(spark, tmp)
    _, dst = _fs(spark, path)
    if fs.exists(dst):      # another writer was faster
        fs.delete(src, True)
        raise FileExistsError(path)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {tmp} to {path}")


def publish_events(df: DataFrame, path: str, granularity: str = "day") -> str:
    """Write the table anew as its next version; readers of an older one keep it.  The version's folder."""
    return versions.publish(df.sparkSession, path, lambda folder: write_events(df, folder, granularity=granularity))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Canonical events of the newest version; ``event_date`` stays available for partition pruning."""
    version = versions.current(spark, path)
    return spark.read.parquet(version["folder"] if version else path).select(*S.EVENT_SCHEMA.fieldNames(), "event_date")


def ensure_canonical(spark: SparkSession, inputs: list[str], build, name: str, granularity: str = "day") -> str:
    """Path of the canonical table for ``inputs``; built and written first if
    it does not exist yet.  ``build()`` returns the canonical DataFrame."""
    key = _fingerprint(spark, inputs)
    path = shared_path(spark, f"canonical/{name}-{key}")
    if not path_exists(spark, path):
        try:
            write_events(build(), path, granularity=granularity)
        except FileExistsError:     # written meanwhile from the same inputs
            pass
    return path


def canonical_events(spark: SparkSession, inputs: list[str], build, name: str,
                     granularity: str = "day") -> DataFrame:
    return read_events(spark, ensure_canonical(spark, inputs, build, name, granularity))
