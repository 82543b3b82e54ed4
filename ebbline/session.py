"""Session construction and cluster-provided settings.

Library code never builds its own session: every public function takes
DataFrames.  ``local_session`` is for tests, the bench and the driver entry.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every job relies on.  UTC is part of the semantics: whole-day
# differences, dates and hours are all taken in UTC.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot user's join partition even when that adds a shuffle before
    # the aggregation that follows (which then combines it map-side)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "ebbline") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def _is_local(spark: SparkSession) -> bool:
    """One process runs everything, so its own disk is shared storage."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is; without it this raises.  Only a local master (tests, local
    runs) may take a fresh scratch folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="ebbline-ckpt-", dir=os.environ.get("EBBLINE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", cur)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def _staging(spark: SparkSession) -> str:
    return shared_path(spark, f"staged/{spark.sparkContext.applicationId}")


def staged_path(spark: SparkSession) -> str:
    """A new path among the application's staged tables."""
    return f"{_staging(spark)}/{uuid.uuid4().hex}"


def staged(df):
    """``df`` written once as Parquet under the shared folder and read back.

    The written rows are facts: every reader sees the same ones, a lost
    executor recomputes nothing upstream, and readers keep column pruning
    and file statistics.  ``clear_staged`` drops all of an application's.
    """
    spark = df.sparkSession
    path = staged_path(spark)
    void = {f.name: F.lit(None).cast("string") for f in df.schema.fields if f.dataType.typeName() == "void"}
    df = df.withColumns(void) if void else df
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what ``staged`` wrote in this application; frames read from it end with it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_staging(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
