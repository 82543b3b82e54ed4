"""JSON-lines event log (S1) and its raw form.

Lines are parsed with ``try_parse_json`` so that a malformed or blank line
is dropped while a well-formed object with one mistyped field is kept (the
field becomes null) - ``mode=DROPMALFORMED`` would drop such lines and
counts differently under column pruning.  Only JSON objects qualify.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.bits import bit_table, maybe_in
from ..session import staged

OCCURRENCES = 10_000   # occurrence numbers of one line that a row holds at a time


def scan_event_log(spark: SparkSession, path: str, schema=S.RAW_EVENT_SCHEMA) -> DataFrame:
    """Raw records with a stable ``event_id``: a hash of the file, the line and its occurrence.

    Reading a file again gives the same ids whatever its splits, and lines of
    two files never share one.  Only lines that are repeated within a file need
    numbers: a first look counts 64-bit hashes of the lines, and all but those
    whose hash occurs twice pass the second look without an exchange.  The
    others (and the few that a bit table of the repeated hashes lets through by
    mistake) are counted and dealt out again with their occurrence numbers, so
    a line that is repeated very often is one row in that exchange.

    The first look runs when this is called.
    """
    v = F.try_parse_json(F.col("value"))
    file = F.col("_metadata.file_path")
    lines = spark.read.text(path).select("value", file.alias("file"), F.xxhash64(file, "value").alias("_h"))
    repeated = staged(lines.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_h"))
    each = lines.select("file", "value", F.lit(0).cast("long").alias("_i"))
    if not repeated.isEmpty():
        marked = maybe_in(lines, staged(bit_table(repeated, "_h")), "_h", "_again")
        each = (marked.filter(~F.col("_again")).select("file", "value", F.lit(0).cast("long").alias("_i"))
                .union(numbered(marked.filter("_again"))))
    raw = each.select(v.alias("v"), F.xxhash64("file", "value", "_i").alias("event_id"))
    obj = raw.filter(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
    cols = [F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return obj.select(*cols, "event_id")


def numbered(lines: DataFrame) -> DataFrame:
    """file, value and occurrence number of all ``lines``; equal ones meet as a count."""
    counts = lines.groupBy("file", "value").agg(F.count(F.lit(1)).alias("n"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / OCCURRENCES)))
    first = F.col("_b") * OCCURRENCES
    return (counts.withColumn("_b", block)
            .withColumn("_i", F.explode(F.sequence(first, F.least(F.col("n"), first + OCCURRENCES) - 1)))
            .select("file", "value", "_i"))


def to_raw_json(events: DataFrame) -> DataFrame:
    """Canonical events -> one JSON object per line (times as epoch ms)."""
    rec = F.struct(
        F.col("userId"), F.unix_millis("ts").alias("ts"), F.unix_millis("registration").alias("registration"),
        F.col("sessionId"), F.col("page"), F.col("level"), F.col("auth"), F.col("method"), F.col("gender"),
        F.col("location"), F.col("artist"), F.col("song"), F.col("length"))
    return events.select(F.to_json(rec).alias("value"))


def write_event_log(events: DataFrame, path: str) -> None:
    to_raw_json(events).write.mode("overwrite").text(path)
