"""Overview and exploration aggregates (A1-A6, A13-A32), top-k (K1-K4),
calendar reindex (J10) and set helpers (U3, U5).

Distinct counts over a second key are always two-level aggregations
(``groupBy(key, other)`` then ``groupBy(key)``), never several
``countDistinct`` in one aggregate (that plans an Expand that copies each
row once per distinct column).  Global scalars are one-row aggregates that
are broadcast, never unpartitioned windows over the data.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import (bin_range, days_between_floor, equal_width_bin, extract_state_nb, first_value_struct,
                         minutes_between, weekday_name)
from ..session import staged
from .cumulative import exact_quantiles
from .labels import per_level, user_columns, user_groups, with_dataset_end
from .scalars import attach_scalars, combine_rows
from .prep import complete_songs, contains_downgrade


def _song() -> F.Column:
    return F.col("page") == "NextSong"


def _count_distinct(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One-row exact distinct count as a two-level aggregation."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().agg(F.count(F.lit(1)).alias(alias))


# A1 ----------------------------------------------------------------------------
def data_overview(df: DataFrame) -> DataFrame:
    base = df.agg(F.count(F.lit(1)).alias("total_events"), F.min("ts").alias("start"), F.max("ts").alias("end"),
                  F.count_if(_song()).alias("song_events"))
    out = attach_scalars(base, _count_distinct(df, "userId", "unique_users"))
    if "sessionId" in df.columns:
        out = attach_scalars(out, _count_distinct(df, "sessionId", "unique_sessions"))
    else:
        out = out.withColumn("unique_sessions", F.lit(None).cast("long"))
    return out.select("total_events", "unique_users", "start", "end",
                      days_between_floor("end", "start").alias("duration_days"), "unique_sessions", "song_events")


# A2 ----------------------------------------------------------------------------
def value_counts(df: DataFrame, cols) -> DataFrame:
    """Long form (column, value, count); nulls are not counted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                for c in cols]))
    return (df.select(pairs.alias("p")).select("p.column", "p.value").filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


# A3 / W8 -----------------------------------------------------------------------
def value_share(df: DataFrame, col: str, places: int = 2) -> DataFrame:
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.round(F.col("count") * 100.0 / total, places))


def percent_of_total(counts: DataFrame, by: list[str], value: str = "count", out: str = "pct") -> DataFrame:
    """Share of ``value`` within groups ``by`` (window over a small count table)."""
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    return counts.withColumn(out, F.col(value) * 100.0 / F.sum(value).over(w))


# A4 ----------------------------------------------------------------------------
def missing_values(df: DataFrame) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column", "nulls")


# A5 / A14 ------------------------------------------------------------------------
def _page_breakdown(df: DataFrame) -> DataFrame:
    pc = df.groupBy("userId", "page").agg(F.count(F.lit(1)).alias("n"))
    return pc.groupBy("userId").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "n")))).alias("page_breakdown"))


def _user_core(df: DataFrame) -> DataFrame:
    return per_level(user_groups(df)).groupBy("userId").agg(*user_columns())


def _user_sessions(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("sessionId").isNotNull()).select("userId", "sessionId").distinct()
              .groupBy("userId").agg(F.count(F.lit(1)).alias("unique_sessions")))


def user_behavior(df: DataFrame) -> DataFrame:
    u = (_user_core(df).join(_user_sessions(df), "userId", "left").join(_page_breakdown(df), "userId", "left"))
    return u.select("userId", "first_activity", "last_activity", "total_events",
                    F.coalesce("unique_sessions", F.lit(0)).alias("unique_sessions"), "page_breakdown",
                    "primary_level", "gender", "location", F.col("registration").alias("registration_date"),
                    days_between_floor("last_activity", "first_activity").alias("activity_span_days"),
                    days_between_floor("last_activity", "registration").alias("days_since_registration"))


def user_summary(df: DataFrame) -> DataFrame:
    """Notebook variant: events_per_day = n/(span+1), registration age from the dataset end."""
    u = with_dataset_end(_user_core(df), df).join(_user_sessions(df), "userId", "left")
    span = days_between_floor("last_activity", "first_activity")
    return u.select("userId", "total_events", "first_activity", "last_activity",
                    F.coalesce("unique_sessions", F.lit(0)).alias("unique_sessions"), "primary_level", "gender",
                    "location", "registration", span.alias("activity_span_days"),
                    (F.col("total_events") / (span + 1)).alias("events_per_day"),
                    days_between_floor("dataset_end", "registration").alias("days_since_registration"))


# A6 ----------------------------------------------------------------------------
def behavior_summary(users: DataFrame) -> DataFrame:
    return users.agg(F.avg("total_events").alias("avg_events_per_user"),
                     F.avg("activity_span_days").alias("avg_activity_span"),
                     F.count_if(F.col("total_events") > 100).alias("users_over_100_events"))


# A13 / U5 -------------------------------------------------------------------------
def event_categories(df: DataFrame) -> DataFrame:
    listed = [p for _, pages in S.EVENT_CATEGORIES for p in pages]
    aggs = [F.count_if(F.col("page").isin(pages)).alias(name) for name, pages in S.EVENT_CATEGORIES]
    aggs.append(F.count_if(~F.coalesce(F.col("page").isin(listed), F.lit(False))).alias("Other"))
    row = df.agg(*aggs)
    names = [n for n, _ in S.EVENT_CATEGORIES] + ["Other"]
    return row.unpivot([], names, "category", "events")


def other_events(df: DataFrame) -> DataFrame:
    listed = [p for _, pages in S.EVENT_CATEGORIES for p in pages]
    return (df.filter(~F.coalesce(F.col("page").isin(listed), F.lit(False)))
              .groupBy("page").agg(F.count(F.lit(1)).alias("events")))


# A15 ---------------------------------------------------------------------------
def activity_segment(n) -> F.Column:
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n < 100, "Low Activity").when(n < 1000, "Medium Activity").otherwise("High Activity")


def activity_segments(users: DataFrame) -> DataFrame:
    return (users.withColumn("activity_segment", activity_segment("total_events"))
                 .groupBy("activity_segment")
                 .agg(F.count(F.lit(1)).alias("users"), F.avg("total_events").alias("avg_events")))


# A16 ---------------------------------------------------------------------------
def crosstab_share(df: DataFrame, row: str, col: str) -> DataFrame:
    """Row-normalised contingency x 100, long form (row, col, count, pct)."""
    c = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("count"))
    return percent_of_total(c, [row], "count", "pct")


# A17 ---------------------------------------------------------------------------
def churn_by_level(users: DataFrame, labels: DataFrame) -> DataFrame:
    j = users.select("userId", "primary_level").join(labels.select("userId", "is_churned"), "userId", "left")
    t = j.groupBy("primary_level").agg(F.count(F.lit(1)).alias("users"),
                                       F.count_if(F.coalesce("is_churned", F.lit(False))).alias("churned"))
    t = t.withColumn("churn_rate", F.col("churned") / F.col("users"))
    best = t.agg(F.min_by("primary_level", F.struct(-F.col("churn_rate"), F.col("primary_level"))).alias("_best"),
                 F.max("churn_rate").alias("_maxrate"))
    return (attach_scalars(t, best)
             .withColumn("is_highest", (F.col("primary_level") == F.col("_best")) & (F.col("_maxrate") > 0))
             .drop("_best", "_maxrate"))


# A18 ---------------------------------------------------------------------------
def song_overview(df: DataFrame) -> DataFrame:
    songs = complete_songs(df)
    base = songs.agg(F.count(F.lit(1)).alias("plays"), F.avg("length").alias("avg_length"))
    span = df.agg(days_between_floor(F.max("ts"), F.min("ts")).alias("_days"))
    out = combine_rows(base, _count_distinct(songs, "artist", "unique_artists"),
                       _count_distinct(songs, "song", "unique_songs"), span)
    return out.select("plays", "unique_artists", "unique_songs", "avg_length",
                      F.try_divide(F.col("plays"), F.col("_days").cast("double")).alias("plays_per_day"))


# A19 ---------------------------------------------------------------------------
def user_music(df: DataFrame) -> DataFrame:
    songs = complete_songs(df)
    base = songs.groupBy("userId").agg(F.count("length").alias("songs_played"),
                                       F.avg("length").alias("avg_song_length"),
                                       F.sum("length").alias("total_listening_time"))
    pairs = (songs.select("userId", F.explode(F.array(
        F.struct(F.lit("a").alias("k"), F.col("artist").alias("v")),
        F.struct(F.lit("s").alias("k"), F.col("song").alias("v")))).alias("p"))
        .select("userId", "p.k", "p.v").distinct()
        .groupBy("userId").agg(F.count_if(F.col("k") == "a").alias("unique_artists"),
                               F.count_if(F.col("k") == "s").alias("unique_songs")))
    u = base.join(pairs, "userId")
    return u.select("userId", "unique_artists", "unique_songs", "songs_played", "avg_song_length",
                    "total_listening_time",
                    (F.col("unique_artists") / F.col("songs_played")).alias("artist_diversity"),
                    (F.col("unique_songs") / F.col("songs_played")).alias("song_diversity"))


# A20 ---------------------------------------------------------------------------
def user_ratings(df: DataFrame) -> DataFrame:
    r = df.filter(F.col("page").isin("Thumbs Up", "Thumbs Down"))
    t = r.groupBy("userId").agg(F.count_if(F.col("page") == "Thumbs Up").alias("thumbs_up"),
                                F.count_if(F.col("page") == "Thumbs Down").alias("thumbs_down"))
    tot = F.col("thumbs_up") + F.col("thumbs_down")
    return t.select("userId", "thumbs_up", "thumbs_down", tot.alias("total_ratings"),
                    F.when(tot > 0, F.col("thumbs_up") / tot).alias("positive_ratio"))


# A21-A24 + J10 ---------------------------------------------------------------------
def _by_time_key(df: DataFrame, key: F.Column, name: str, sessions: bool = False) -> DataFrame:
    """Per time key: events, song plays, distinct users (and sessions).

    Users and sessions are counted as the rows of one group-by each, so no
    row is expanded for a second distinct count; with sessions that is two
    scans of a few narrow columns, both combined map-side."""
    keyed = df.withColumn(name, key)
    zero = F.lit(0).cast("long")
    users = keyed.groupBy(name, "userId").agg(F.count(F.lit(1)).alias("c"), F.count_if(_song()).alias("s"))
    parts = users.select(name, "c", "s", F.col("userId").isNotNull().cast("long").alias("u"), zero.alias("v"))
    if sessions:
        seen = keyed.filter(F.col("sessionId").isNotNull()).select(name, "sessionId").distinct()
        parts = parts.union(seen.select(name, zero, zero, zero, F.lit(1).cast("long")))
    aggs = [F.sum("c").alias("total_events"), F.sum("s").alias("song_plays"), F.sum("u").alias("unique_users")]
    if sessions:
        aggs.append(F.sum("v").alias("unique_sessions"))
    return parts.groupBy(name).agg(*aggs)


def daily_stats(df: DataFrame) -> DataFrame:
    t = _by_time_key(df, F.to_date("ts"), "date", sessions=True)
    return t.select("date", "unique_users", "total_events", "unique_sessions", "song_plays",
                    (F.col("total_events") / F.col("unique_users")).alias("events_per_user"),
                    (F.col("song_plays") / F.col("unique_users")).alias("songs_per_user"))


def hourly_stats(df: DataFrame) -> DataFrame:
    return _by_time_key(df, F.hour("ts"), "hour").select("hour", "unique_users", "total_events")


def calendar_weekdays(spark) -> DataFrame:
    return spark.createDataFrame([(i + 1, d) for i, d in enumerate(S.WEEKDAYS)], "dow int, day_of_week string")


def dow_stats(df: DataFrame) -> DataFrame:
    """Per weekday name, completed Monday..Sunday (absent -> null), J10."""
    t = _by_time_key(df, weekday_name("ts"), "day_of_week").select("day_of_week", "unique_users", "total_events")
    cal = F.broadcast(calendar_weekdays(df.sparkSession))   # 7 rows
    return cal.join(t, "day_of_week", "left").select("dow", "day_of_week", "unique_users", "total_events")


def weekly_stats(df: DataFrame) -> DataFrame:
    return _by_time_key(df, F.weekofyear("ts"), "week").select("week", "unique_users", "total_events")


# K4 ----------------------------------------------------------------------------
def argmax_argmin(stats: DataFrame, key: str, value: str = "total_events", order_key: str | None = None,
                  dimension: str | None = None) -> DataFrame:
    """Peak and lowest ``key`` by ``value``; ties go to the earliest key."""
    ok = F.col(order_key or key)
    s = stats.filter(F.col(value).isNotNull())
    row = s.agg(F.min_by(F.col(key).cast("string"), F.struct(-F.col(value), ok)).alias("peak_key"),
                F.max(value).alias("peak_value"),
                F.min_by(F.col(key).cast("string"), F.struct(F.col(value), ok)).alias("low_key"),
                F.min(value).alias("low_value"))
    return row.select(F.lit(dimension or key).alias("dimension"), "*")


# A25 ---------------------------------------------------------------------------
def session_summary(df: DataFrame) -> DataFrame:
    """Per sessionId alone: events, start, end, user of the first row, songs, minutes."""
    s = (df.filter(F.col("sessionId").isNotNull()).groupBy("sessionId")
           .agg(F.count(F.lit(1)).alias("events_count"), F.min("ts").alias("start_time"),
                F.max("ts").alias("end_time"), first_value_struct(None, "userId")["userId"].alias("userId"),
                F.count_if(_song()).alias("songs_played")))
    return s.withColumn("duration_minutes", minutes_between("start_time", "end_time"))


def session_stats(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count(F.lit(1)).alias("total_sessions"),
                        F.avg("duration_minutes").alias("avg_duration_minutes"),
                        F.avg("events_count").alias("avg_events"), F.avg("songs_played").alias("avg_songs"),
                        F.max("duration_minutes").alias("max_duration_minutes"))


# A26 ---------------------------------------------------------------------------
def recency_buckets(df: DataFrame, buckets=(7, 30, 60)) -> DataFrame:
    last = with_dataset_end(df.groupBy("userId").agg(F.max("ts").alias("last")), df)
    d = days_between_floor("dataset_end", "last")
    return last.agg(*[F.count_if(d <= b).alias(f"active_last_{b}d") for b in buckets],
                    F.count(F.lit(1)).alias("users"))


# A27 ---------------------------------------------------------------------------
def downgrade_users(df: DataFrame) -> DataFrame:
    dg = df.filter(contains_downgrade())
    a = dg.agg(F.count(F.lit(1)).alias("downgrade_events"))
    b = _count_distinct(dg.select("userId"), "userId", "downgrade_users")
    c = _count_distinct(df.filter(F.col("page") == "Submit Downgrade").select("userId"), "userId",
                        "submit_downgrade_users")
    return combine_rows(a, b, c)


# A28 ---------------------------------------------------------------------------
def level_transition_users(df: DataFrame) -> DataFrame:
    n = df.select("userId", "level").distinct().groupBy("userId").agg(F.count("level").alias("n_levels"))
    return n.filter(F.col("n_levels") > 1)


# A29 ---------------------------------------------------------------------------
def risk_factors(df: DataFrame, users: DataFrame | None = None) -> DataFrame:
    users = users if users is not None else user_summary(df)
    flags = df.groupBy("userId").agg(
        F.max(contains_downgrade().cast("int")).alias("has_downgrade"),
        F.size(F.collect_set("level")).alias("_nlev"))   # bounded by the level domain
    u = users.select("userId", "total_events", "activity_span_days").join(flags, "userId")
    score = (F.col("has_downgrade") + (F.col("_nlev") > 1).cast("int")
             + (F.col("total_events") < 100).cast("int") + (F.col("activity_span_days") < 7).cast("int"))
    cat = (F.when(score >= 3, "High Risk").when(score >= 2, "Medium Risk").when(score >= 1, "Low Risk")
           .otherwise("No Risk"))
    return u.select("userId", F.col("has_downgrade").cast("boolean").alias("has_downgrade"),
                    (F.col("_nlev") > 1).alias("level_changes"), (F.col("total_events") < 100).alias("low_activity"),
                    (F.col("activity_span_days") < 7).alias("short_tenure"), score.alias("risk_score"),
                    cat.alias("risk_category"))


def risk_distribution(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_category").agg(F.count(F.lit(1)).alias("users"))


# A30 ---------------------------------------------------------------------------
COMPARE_METRICS = ["total_events", "unique_sessions", "activity_span_days", "events_per_day"]


def churned_vs_active(users: DataFrame, labels: DataFrame) -> DataFrame:
    j = users.join(labels.select("userId", "is_churned"), "userId")
    g = j.groupBy("is_churned").agg(*[F.avg(m).alias(m) for m in COMPARE_METRICS])
    long = g.unpivot(["is_churned"], COMPARE_METRICS, "metric", "avg")
    w = long.groupBy("metric").agg(F.max(F.when(F.col("is_churned"), F.col("avg"))).alias("churned_avg"),
                                   F.max(F.when(~F.col("is_churned"), F.col("avg"))).alias("active_avg"))
    diff = F.when(F.col("active_avg") > 0, (F.col("churned_avg") - F.col("active_avg")) / F.col("active_avg") * 100)
    return w.withColumn("difference_pct", F.coalesce(diff, F.lit(0.0)))


# A31 ---------------------------------------------------------------------------
def key_medians(users: DataFrame) -> DataFrame:
    users = staged(users)
    median = exact_quantiles(users, {"median": ("total_events", 0.5)})["median"]
    return users.agg(F.lit(median).cast("double").alias("median_events"),
                     F.avg("activity_span_days").alias("avg_activity_span"),
                     F.max("total_events").alias("max_events"),
                     F.count("registration").alias("registered_users"),
                     (F.count("registration") * 100.0 / F.count(F.lit(1))).alias("registered_pct"))


# A32 ---------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] of ``col``: bin, lo, hi, count.

    Every bin is present (zero counts included): the bin grid is a tiny
    generated frame joined with the per-bin counts (J9 shape).
    """
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    rng = v.agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    lo, hi = bin_range(F.col("mn"), F.col("mx"))
    rng = rng.select(lo.alias("lo"), hi.alias("hi"))
    counts = (attach_scalars(v, rng).withColumn("bin", equal_width_bin("v", "lo", "hi", bins))
               .filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    grid = grid.select("bin", (F.col("bin").cast("double") * step + F.col("lo")).alias("bin_lo"),
                       F.when(F.col("bin") == bins - 1, F.col("hi"))
                        .otherwise((F.col("bin") + 1).cast("double") * step + F.col("lo")).alias("bin_hi"))
    return (grid.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))
                .withColumn("column", F.lit(col)))


# K1 ----------------------------------------------------------------------------
def sort_events(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Events clustered by user and ordered by (ts, event_id) inside each
    partition.  Range clustering on (userId, ts, event_id) rather than a hash
    on userId: a user holding a large share of the log is split over several
    partitions (each still internally ordered) instead of becoming one task."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return df.repartitionByRange(n, "userId", "ts", "event_id").sortWithinPartitions("userId", "ts", "event_id")


# K2 / K3 ----------------------------------------------------------------------------
TRACKED = 10_000       # values that the heavy-hitter sketch follows
SKETCH_FROM = 1 << 30  # estimated bytes of input from which a second look at it is cheaper than an exchange of all values


def heavy_counts(df: DataFrame, cols: list[str], k: int, tracked: int = TRACKED) -> DataFrame | None:
    """Exact counts of values of ``cols`` that surely include the ``k`` most frequent; None where that is not proven.

    A mergeable frequent-items sketch (one of bounded size for each task) names
    the candidates, and only rows with a candidate's hash are counted.  A value
    that the sketch does not name has at most ``2 * 3.5 / size`` of all rows,
    ``size`` being that of its table.  So the result is proven if the k-th count is above that,
    or if the candidates hold all rows.  At most ``tracked`` names and counts reach the driver.
    """
    spark = df.sparkSession
    rows = df.dropna(subset=cols).withColumn("_h", F.xxhash64(*cols))
    found = rows.agg(F.expr(f"approx_top_k(_h, {tracked}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return rows.select(*cols, F.lit(0).cast("long").alias("count")).limit(0)
    names = spark.createDataFrame([(t["item"],) for t in found["top"]], "_h long")          # at most ``tracked`` rows
    counts = rows.join(F.broadcast(names), "_h").groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    exact = counts.collect()                                                               # one for each name
    by_size = sorted((r["count"] for r in exact), reverse=True)
    bound = 2 * 3.5 / (1 << max(3, math.ceil(math.log2(tracked / 0.75)))) * found["n"]
    proven = sum(by_size) == found["n"] or len(by_size) >= k and by_size[k - 1] > bound
    return spark.createDataFrame(exact, counts.schema) if proven else None


def top_k(df: DataFrame, cols: list[str], k: int, dimension: str | None = None, tracked: int = TRACKED,
          sketch_from: int = SKETCH_FROM) -> DataFrame:
    """Top ``k`` values of ``cols`` by count; ties broken by the key (ascending).

    Large inputs are first sketched, and only the candidates are counted where
    these are proven to be enough (:func:`heavy_counts`); else every value is.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    c = heavy_counts(df, cols, k, tracked) if size >= sketch_from else None
    if c is None:
        c = df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    # The count table is small next to the events; the ordered limit is a
    # per-partition top-k followed by a k-row merge (TakeOrderedAndProject).
    top = c.orderBy(F.col("count").desc(), *[F.col(x).asc() for x in cols]).limit(k)
    w = W.orderBy(F.col("count").desc(), *[F.col(x).asc() for x in cols])
    return top.withColumn("rank", F.row_number().over(w)).withColumn("dimension", F.lit(dimension or cols[0]))


def user_states(users: DataFrame) -> DataFrame:
    return users.withColumn("state", extract_state_nb("location"))


# U3 ----------------------------------------------------------------------------
def category_union(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    return a.select(col).union(b.select(col)).distinct()
