"""Adapters from the provided tables to the canonical event schema.

Adapter A maps ``events`` (+ ``customer``) to music-service events; adapter
B maps ``orders`` (+ ``customer``) to one event per order.  Both are plain
column expressions plus one hash join on the customer key; the only
order-dependent step (gap sessions) is skew-safe, see
:mod:`ebbline.operators.sessions`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DAY_US
from ..operators.sessions import gap_session_seq

# Fixed values of the adapters (FIXTURES.md §3-§4)
SESSION_GAP_SECONDS = 6 * 3600
STATE_BY_NATION_MOD7 = ["CA", "NY-NJ-PA", "TX", "FL", "CT", "IL"]  # index 6 -> no location
REGISTRATION_BASE = "2023-12-01 00:00:00"
PAID_UNTIL_MOD0 = "2024-01-12 00:00:00"
FREE_UNTIL_MOD1 = "2024-01-18 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _gender(uid) -> F.Column:
    return F.when(uid % 3 == 0, "M").when(uid % 3 == 1, "F")


def _customer_location(customer: DataFrame) -> DataFrame:
    nat = F.col("c_nationkey") % 7
    state = F.element_at(F.array(*[F.lit(s) for s in STATE_BY_NATION_MOD7]), (nat + 1).cast("int"))
    loc = F.when(nat < 6, F.concat(F.col("c_mktsegment"), F.lit(", "), state))
    return customer.select(F.col("c_custkey").alias("_ck"), loc.alias("location"))


def activity_events(events: DataFrame, customer: DataFrame,
                    gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Adapter A: ``events`` -> canonical events."""
    uid = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    page = (F.when(et == "view", "NextSong")
            .when(et == "click", F.when(k % 4 <= 1, "Thumbs Up").when(k % 4 == 2, "Thumbs Down")
                  .otherwise("Add to Playlist"))
            .when(et == "purchase", F.when(k % 2 == 0, "Add Friend").otherwise("Roll Advert"))
            .when(et == "signup", F.when(k < 10, "Submit Upgrade").otherwise("Home"))
            .when(et == "error", F.when(k >= 97, "Submit Downgrade").when(k >= 94, "Downgrade")
                  .otherwise("Help")))
    ts = F.col("ts").cast("timestamp")
    level = (F.when(uid % 3 == 0, F.when(ts < F.lit(PAID_UNTIL_MOD0).cast("timestamp"), "paid").otherwise("free"))
             .when(uid % 3 == 1, F.when(ts < F.lit(FREE_UNTIL_MOD1).cast("timestamp"), "free").otherwise("paid"))
             .otherwise("free"))
    reg = F.when(uid % 11 != 0, F.timestamp_micros(
        F.unix_micros(F.lit(REGISTRATION_BASE).cast("timestamp")) + ((uid * 37) % 45) * F.lit(DAY_US)))
    base = events.select(
        "event_id", "user_id", ts.alias("ts"), k.alias("_k"), F.col("value"), page.alias("page"))
    base = (base.withColumn("level", level)
                .withColumn("registration", reg))
    sess = gap_session_seq(base, key="user_id", ts="ts", gap_seconds=gap_seconds)
    song = F.col("page") == "NextSong"
    out = sess.join(_customer_location(customer), F.col("user_id") == F.col("_ck"), "left")
    return out.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("ts"),
        F.col("registration"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("session_seq").cast("string")).alias("sessionId"),
        F.col("page"),
        F.col("level"),
        F.lit("Logged In").alias("auth"),
        F.when(song, "PUT").otherwise("GET").alias("method"),
        _gender(F.col("user_id")).alias("gender"),
        F.col("location"),
        F.when(song, F.concat(F.lit("A"), (F.col("_k") % 20).cast("string"))).alias("artist"),
        F.when(song, F.concat(F.lit("S"), F.col("_k").cast("string"))).alias("song"),
        F.when(song, F.col("value")).alias("length"),
    )


def order_events(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Adapter B: one ``NextSong`` event per order; day-grain timestamps (ties)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      F.col("o_orderdate").cast("timestamp").alias("ts"))
    first = o.groupBy("o_custkey").agg(F.min("ts").alias("_first"))
    o = o.join(first, "o_custkey")
    o = o.join(_customer_location(customer), F.col("o_custkey") == F.col("_ck"), "left")
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").cast("string").alias("userId"),
        F.col("ts"),
        F.timestamp_micros(F.unix_micros("_first") - F.lit(30 * DAY_US)).alias("registration"),
        F.col("o_orderkey").cast("string").alias("sessionId"),
        F.lit("NextSong").alias("page"),
        F.when(F.col("o_orderstatus") == "F", "paid").otherwise("free").alias("level"),
        F.lit("Logged In").alias("auth"),
        F.lit("PUT").alias("method"),
        _gender(F.col("o_custkey")).alias("gender"),
        F.col("location"),
        F.lit(None).cast("string").alias("artist"),
        F.lit(None).cast("string").alias("song"),
        F.col("o_totalprice").alias("length"),
    )


def _sf(sf_dir: str, *names: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]


def load_activity_events(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Cleaned canonical events of adapter A (materialized once, then read)."""
    from ..operators.prep import fill_unknown
    from .canonical import canonical_events

    def build():
        return fill_unknown(activity_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "customer")))
    if not materialize:
        return build()
    return canonical_events(spark, _sf(sf_dir, "events", "customer"), build, "activity")


def load_order_events(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Cleaned canonical events of adapter B (materialized once, then read)."""
    from ..operators.prep import fill_unknown
    from .canonical import canonical_events

    def build():
        return fill_unknown(order_events(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")))
    if not materialize:
        return build()
    return canonical_events(spark, _sf(sf_dir, "orders", "customer"), build, "orders", granularity="month")


def activity_events_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of the materialized adapter-A table (built if needed)."""
    from ..operators.prep import fill_unknown
    from .canonical import ensure_canonical
    return ensure_canonical(spark, _sf(sf_dir, "events", "customer"), lambda: fill_unknown(
        activity_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "customer"))), "activity")
