"""Churn labels (A7-A12) with their joins and set operations.

The labelled table is one aggregation over the events keyed by userId plus a
one-row broadcast of the dataset end; priority explicit > subscription >
inactivity is a ``coalesce``.  ``churn_labels_setwise`` builds the same table
the set-wise way (anti-joins + union) and serves as a cross-check.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import days_between_floor, first_value_struct


def _explicit(after=None) -> F.Column:
    c = F.col("page").isin(S.EXPLICIT_CHURN_PAGES)
    return c if after is None else c & (F.col("ts") > F.lit(after).cast("timestamp"))


# J7 ----------------------------------------------------------------------------
def dataset_end(df: DataFrame) -> DataFrame:
    """One-row frame with the global max ts; safe to broadcast (one row)."""
    return df.agg(F.max("ts").alias("dataset_end"))


def with_dataset_end(users: DataFrame, events: DataFrame) -> DataFrame:
    """Attach the dataset end (global max ts) to a per-user table as a scalar
    subquery: a one-column scan with map-side max, one row per task."""
    return users.withColumn("dataset_end", events.agg(F.max("ts")).scalar())


# A7 ----------------------------------------------------------------------------
def explicit_churn(df: DataFrame) -> DataFrame:
    first = first_value_struct(None, "page")
    return (df.filter(_explicit()).groupBy("userId")
              .agg(F.min("ts").alias("churn_timestamp"), first["page"].alias("churn_event"))
              .withColumn("churn_type", F.lit("explicit")))


def _level_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("userId").agg(
        F.min(F.when(F.col("level") == "paid", F.col("ts"))).alias("first_paid"),
        F.min(F.when(F.col("level") == "free", F.col("ts"))).alias("first_free"),
        F.max("ts").alias("last_activity"))


# A9 ----------------------------------------------------------------------------
def subscription_churn(df: DataFrame, inactivity_days: int = 30) -> DataFrame:
    """First paid row, then a later first free row, activity after it, and
    ``>= inactivity_days`` floored days idle before the dataset end."""
    s = with_dataset_end(_level_summary(df), df)
    days = days_between_floor("dataset_end", "last_activity")
    cond = (F.col("first_free") > F.col("first_paid")) & (F.col("last_activity") > F.col("first_free")) \
        & (days >= inactivity_days)
    return s.filter(cond).select("userId", F.col("first_free").alias("churn_timestamp"),
                                 F.lit("subscription_downgrade").alias("churn_type"),
                                 days.alias("days_inactive"))


# A8 ----------------------------------------------------------------------------
def inactivity_churn(df: DataFrame, inactivity_days: int = 30) -> DataFrame:
    last = with_dataset_end(df.groupBy("userId").agg(F.max("ts").alias("last_activity")), df)
    days = days_between_floor("dataset_end", "last_activity")
    return last.filter(days >= inactivity_days).select(
        "userId", F.col("last_activity").alias("churn_timestamp"),
        F.lit("inactivity").alias("churn_type"), days.alias("days_inactive"))


# A11 ---------------------------------------------------------------------------
FIRST_SEEN = ("registration", "gender", "location")


def user_groups(df: DataFrame, *more: F.Column) -> DataFrame:
    """Events counted per user, level, registration, gender and location (and ``more``): ``c``, ``lo``, ``hi``, ``key``.

    ``lo`` and ``hi`` are the least and greatest ts, and ``key`` the least
    (ts, event_id) as one number, nulls first.  All are of fixed width, so
    events are combined by hash before the exchange: what a task holds grows
    with its groups, not with its events.  Texts are compared group by group.
    """
    whole = lambda n, digits: F.lit(str(n)).cast(f"decimal({digits},0)")
    at = F.coalesce(F.unix_micros("ts"), F.lit(-(10 ** 17))).cast("decimal(18,0)") * whole(10 ** 20, 21)
    of = F.coalesce(F.col("event_id").cast("decimal(20,0)") + whole(2 ** 63 + 1, 20), whole(0, 20))
    return df.groupBy("userId", "level", *FIRST_SEEN, *more).agg(
        F.count(F.lit(1)).alias("c"), F.min("ts").alias("lo"), F.max("ts").alias("hi"),
        F.min((at + of).cast("decimal(38,0)")).alias("key"))


def per_level(groups: DataFrame, *aggs: F.Column) -> DataFrame:
    """Groups of :func:`user_groups` combined to one row for each user and level: ``c`` and ``lo``, ``hi``, first values, ``aggs``."""
    return groups.groupBy("userId", "level").agg(
        F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), *aggs,
        *[F.min(F.when(F.col(c).isNotNull(), F.struct("key", c))).alias(f"_{c}") for c in FIRST_SEEN])


def user_columns() -> list[F.Column]:
    """First and last activity, total, modal level (ties: smallest) and first values, over rows of :func:`per_level`."""
    most = F.min(F.when(F.col("level").isNotNull(), F.struct((-F.col("c")).alias("n"), "level")))["level"]
    return [F.min("lo").alias("first_activity"), F.max("hi").alias("last_activity"), F.sum("c").alias("total_events"),
            most.alias("primary_level"), *[F.min(f"_{c}")[c].alias(c) for c in FIRST_SEEN]]


def user_metadata(df: DataFrame) -> DataFrame:
    """first/last activity, total, modal level (ties: smallest), first non-null
    registration/gender/location, span days, days from registration to last."""
    m = per_level(user_groups(df)).groupBy("userId").agg(*user_columns())
    return (m.withColumn("activity_span_days", days_between_floor("last_activity", "first_activity"))
             .withColumn("days_since_registration", days_between_floor("last_activity", "registration")))


LABEL_COLUMNS = ["userId", "churn_timestamp", "churn_event", "churn_type", "is_churned", "first_activity",
                 "last_activity", "total_events", "primary_level", "registration", "gender", "location",
                 "activity_span_days", "days_since_registration"]


# A10 ---------------------------------------------------------------------------
def churn_labels(df: DataFrame, inactivity_days: int = 30, explicit_after=None) -> DataFrame:
    """One pass: per-user aggregate + dataset end, priority by ``coalesce``.

    ``explicit_after`` (optional, e.g. the feature cutoff) counts only explicit
    churn pages after that time - a post-cutoff label that cannot share
    events with the downgrade features.  Default: the reference's whole-log
    label.
    """
    groups = user_groups(df, F.when(_explicit(explicit_after), F.col("page")).alias("_explicit"))
    said = F.col("_explicit").isNotNull()
    levels = per_level(groups, F.min(F.when(said, F.col("lo"))).alias("_explicit_ts"),
                       F.min(F.when(said, F.struct("key", "_explicit"))).alias("_explicit"))
    agg = levels.groupBy("userId").agg(
        F.min("_explicit_ts").alias("explicit_ts"), F.min("_explicit")["_explicit"].alias("explicit_page"),
        F.min(F.when(F.col("level") == "paid", F.col("lo"))).alias("first_paid"),
        F.min(F.when(F.col("level") == "free", F.col("lo"))).alias("first_free"), *user_columns())
    a = with_dataset_end(agg, df)
    idle = days_between_floor("dataset_end", "last_activity")
    sub = (F.col("first_free") > F.col("first_paid")) & (F.col("last_activity") > F.col("first_free")) \
        & (idle >= inactivity_days)
    inact = idle >= inactivity_days
    expl = F.col("explicit_ts").isNotNull()
    ctype = (F.when(expl, "explicit").when(sub, "subscription_downgrade").when(inact, "inactivity")
             .otherwise("not_churned"))
    cts = (F.when(expl, F.col("explicit_ts")).when(sub, F.col("first_free"))
           .when(inact, F.col("last_activity")))
    return (a.withColumn("churn_timestamp", cts)
             .withColumn("churn_event", F.when(expl, F.col("explicit_page")))
             .withColumn("churn_type", ctype)
             .withColumn("is_churned", F.col("churn_timestamp").isNotNull())
             .withColumn("activity_span_days", days_between_floor("last_activity", "first_activity"))
             .withColumn("days_since_registration", days_between_floor("last_activity", "registration"))
             .select(*LABEL_COLUMNS))


def churn_labels_setwise(df: DataFrame, inactivity_days: int = 30) -> DataFrame:
    """Same table via J5 anti-joins, U1 union and J1/J2 joins (reference shape)."""
    users = df.select("userId").distinct()                                   # U2
    e = explicit_churn(df)
    s = subscription_churn(df, inactivity_days).join(e.select("userId"), "userId", "left_anti")   # J5
    taken = e.select("userId").unionByName(s.select("userId"))
    i = inactivity_churn(df, inactivity_days).join(taken, "userId", "left_anti")                 # J5
    churned = (e.unionByName(s.drop("days_inactive"), allowMissingColumns=True)                  # U1
                .unionByName(i.drop("days_inactive"), allowMissingColumns=True))
    lab = users.join(churned, "userId", "left")                                                    # J1
    lab = (lab.withColumn("is_churned", F.col("churn_timestamp").isNotNull())
              .withColumn("churn_type", F.coalesce("churn_type", F.lit("not_churned"))))
    return lab.join(user_metadata(df), "userId", "inner").select(*LABEL_COLUMNS)                  # J2


# A12 ---------------------------------------------------------------------------
def churn_statistics(labels: DataFrame) -> DataFrame:
    """Long form over GROUPING SETS ((), (churn_type), (primary_level), (gender)).

    Columns: dimension, value, users, churned, churn_rate.
    """
    lab = labels.withColumn("_c", F.col("is_churned").cast("long"))
    rows = lab.groupingSets(
        [[], ["churn_type"], ["primary_level"], ["gender"]],
        "churn_type", "primary_level", "gender",
    ).agg(F.count(F.lit(1)).alias("users"), F.sum("_c").alias("churned"),
          F.grouping_id().alias("_gid"))
    dim = (F.when(F.col("_gid") == 7, "all").when(F.col("_gid") == 3, "churn_type")
           .when(F.col("_gid") == 5, "primary_level").otherwise("gender"))
    val = (F.when(F.col("_gid") == 3, F.col("churn_type")).when(F.col("_gid") == 5, F.col("primary_level"))
           .when(F.col("_gid") == 6, F.col("gender")))
    return rows.select(dim.alias("dimension"), val.alias("value"), "users", "churned",
                       (F.col("churned") / F.col("users")).alias("churn_rate"))


# J6 ----------------------------------------------------------------------------
def membership_flag(df: DataFrame, members: DataFrame, name: str, key: str = "userId") -> DataFrame:
    """Boolean column "key in members" via a left join on distinct keys."""
    m = members.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(m, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
