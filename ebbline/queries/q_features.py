"""X1-X14 feature queries, J3/J4 joins, W1-W4 windows."""
from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..catalog import CUTOFF_A, INACTIVITY_A, ev_a, register
from ..operators import features as X
from ..operators import labels as L
from ..oracle import R, days, minutes, with_ev

D_US = 86400000000


def feature_ctes(cutoff: str | None, src: str = "ev") -> str:
    """CTEs ``fm`` (feature matrix, unrounded) over ``ev``.  Straight SQL:
    direct count(DISTINCT) and ordered aggregates, no shared code with Spark."""
    if cutoff:
        cr = f"SELECT *, TIMESTAMP '{cutoff}' AS cref FROM {src} WHERE ts <= TIMESTAMP '{cutoff}'"
    else:
        cr = f"SELECT *, max(ts) OVER (PARTITION BY userId) AS cref FROM {src}"

    def back(n):
        return f"make_timestamp(epoch_us(cref) - {n * D_US})"

    rec = []
    for n in S.RECENT_WINDOWS:
        rec += [f"count(*) FILTER (WHERE ts >= {back(n)}) AS e{n}",
                f"count(DISTINCT sessionId) FILTER (WHERE ts >= {back(n)}) AS s{n}",
                f"count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE ts >= {back(n)}) AS d{n}"]
    rec.append(f"count(*) FILTER (WHERE ts >= {back(3)}) AS e3")
    pages = [f"count(*) FILTER (WHERE page = '{p}') AS {name}" for name, p in S.PAGE_COUNT_FEATURES]
    return f"""
cr AS ({cr}),
crn AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, event_id) AS pos FROM cr),
u AS (
  SELECT userId, any_value(cref) AS cref, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n,
    first(registration ORDER BY ts, event_id) AS reg0,
    first(gender ORDER BY ts, event_id) AS gender0,
    first(location ORDER BY ts, event_id) AS loc0,
    last(level ORDER BY ts, event_id) AS cur_level,
    {', '.join(rec)},
    count(DISTINCT sessionId) AS us,
    {', '.join(pages)},
    count(DISTINCT artist) FILTER (WHERE page = 'NextSong') AS ua,
    count(DISTINCT song) FILTER (WHERE page = 'NextSong') AS usg,
    avg(length) FILTER (WHERE page = 'NextSong') AS asl,
    coalesce(sum(length) FILTER (WHERE page = 'NextSong'), 0) AS tlt,
    count(DISTINCT level) AS nlev,
    count(*) FILTER (WHERE level = 'paid') AS ep, count(*) FILTER (WHERE level = 'free') AS ef,
    min(ts) FILTER (WHERE level = 'paid') AS pmin, max(ts) FILTER (WHERE level = 'paid') AS pmax,
    min(ts) FILTER (WHERE level = 'free') AS fmin, max(ts) FILTER (WHERE level = 'free') AS fmax,
    min(pos) FILTER (WHERE level = 'paid') AS ppos, min(pos) FILTER (WHERE level = 'free') AS fpos,
    count(*) FILTER (WHERE page LIKE '%Downgrade%') AS dg,
    max(ts) FILTER (WHERE page LIKE '%Downgrade%') AS dglast
  FROM crn GROUP BY userId),
ss AS (SELECT userId, sessionId, {minutes('min(ts)', 'max(ts)')} AS dur,
              count(*) FILTER (WHERE page = 'NextSong') AS ssongs
       FROM cr WHERE sessionId IS NOT NULL GROUP BY 1, 2),
sa AS (SELECT userId, avg(dur) AS avg_dur, avg(ssongs) AS avg_ssongs, max(dur) AS max_dur,
              coalesce(stddev_samp(dur), 0) AS std_dur FROM ss GROUP BY 1),
dd AS (SELECT userId, CAST(ts AS DATE) AS d, count(*) AS de, count(DISTINCT sessionId) AS ds,
              count(*) FILTER (WHERE page = 'NextSong') AS dsg FROM cr GROUP BY 1, 2),
dr AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY d DESC) AS rn,
              count(*) OVER (PARTITION BY userId) AS nd FROM dd),
ta AS (SELECT userId, max(nd) AS nd,
         avg(de) FILTER (WHERE rn <= 7) AS re, avg(de) FILTER (WHERE rn > 7 OR nd = 7) AS he,
         avg(ds) FILTER (WHERE rn <= 7) AS rs, avg(ds) FILTER (WHERE rn > 7 OR nd = 7) AS hs,
         avg(dsg) FILTER (WHERE rn <= 7) AS rsg, avg(dsg) FILTER (WHERE rn > 7 OR nd = 7) AS hsg
       FROM dr GROUP BY 1),
fx AS (
  SELECT a.userId, u.*, sa.*, ta.*,
    CASE WHEN len(split(u.loc0, ',')) >= 2 AND u.loc0 <> '' THEN trim(split(u.loc0, ',')[-1]) END AS st
  FROM (SELECT DISTINCT userId FROM {src}) a
  LEFT JOIN u ON u.userId = a.userId LEFT JOIN sa ON sa.userId = a.userId LEFT JOIN ta ON ta.userId = a.userId),
fm AS (
  SELECT fx.userId AS userId,
    {days('cref', 'reg0')} AS days_since_registration,
    {days('cref', 'first_ts')} AS days_since_first_event,
    {days('cref', 'last_ts')} AS days_since_last_event,
    {days('last_ts', 'first_ts')} AS user_activity_span_days,
    n AS total_events,
    n / greatest({days('last_ts', 'first_ts')}, 1) AS events_per_day,
    us AS unique_sessions,
    n / greatest(us, 1) AS avg_events_per_session,
    e7 AS events_last_7d, s7 AS sessions_last_7d, d7 AS days_active_last_7d, e7 / 7.0 AS avg_events_per_day_last_7d,
    e14 AS events_last_14d, s14 AS sessions_last_14d, d14 AS days_active_last_14d,
    e14 / 14.0 AS avg_events_per_day_last_14d,
    e30 AS events_last_30d, s30 AS sessions_last_30d, d30 AS days_active_last_30d,
    e30 / 30.0 AS avg_events_per_day_last_30d,
    songs_played, thumbs_up, thumbs_down, playlist_additions, friend_additions, roll_adverts,
    songs_played / n AS songs_ratio,
    (thumbs_up + thumbs_down) / greatest(songs_played, 1) AS engagement_ratio,
    thumbs_up / greatest(thumbs_up + thumbs_down, 1) AS positive_feedback_ratio,
    playlist_additions / greatest(songs_played, 1) AS playlist_ratio,
    friend_additions / n AS social_ratio,
    CASE WHEN songs_played > 0 THEN ua END AS unique_artists,
    CASE WHEN songs_played > 0 THEN usg END AS unique_songs,
    asl AS avg_song_length, CASE WHEN songs_played > 0 THEN tlt END AS total_listening_time,
    CASE WHEN songs_played > 0 THEN ua / songs_played END AS artist_diversity,
    CASE WHEN songs_played > 0 THEN usg / songs_played END AS song_diversity,
    avg_dur AS avg_session_duration, avg_ssongs AS avg_songs_per_session, max_dur AS max_session_duration,
    std_dur AS session_duration_std,
    CAST(cur_level = 'paid' AS INTEGER) AS current_level_paid,
    CAST(cur_level = 'free' AS INTEGER) AS current_level_free,
    nlev - 1 AS subscription_changes,
    CAST(ep > 0 AS INTEGER) AS ever_paid, CAST(ef > 0 AS INTEGER) AS ever_free,
    CASE WHEN nlev > 1 THEN CAST(coalesce(ppos > fpos, false) AS INTEGER) END AS upgraded_to_paid,
    CASE WHEN nlev > 1 THEN CAST(coalesce(fpos > ppos, false) AS INTEGER) END AS downgraded_to_free,
    coalesce({days('pmax', 'pmin')}, 0) AS days_as_paid,
    coalesce({days('fmax', 'fmin')}, 0) AS days_as_free,
    ep AS events_as_paid, ef AS events_as_free,
    dg AS downgrade_events,
    CASE WHEN n IS NOT NULL THEN coalesce({days('last_ts', 'dglast')}, 999) END AS days_since_downgrade,
    CASE WHEN nd >= 7 THEN re / greatest(he, 1) END AS activity_trend_events,
    CASE WHEN nd >= 7 THEN rs / greatest(hs, 1) END AS activity_trend_sessions,
    CASE WHEN nd >= 7 THEN rsg / greatest(hsg, 1) END AS activity_trend_songs,
    1 - e3 / greatest(n * 3.0 / greatest({days('last_ts', 'first_ts')}, 1), 1) AS activity_decline_3d,
    1 - e7 / greatest(n * 7.0 / greatest({days('last_ts', 'first_ts')}, 1), 1) AS activity_decline_7d,
    1 - e14 / greatest(n * 14.0 / greatest({days('last_ts', 'first_ts')}, 1), 1) AS activity_decline_14d,
    CAST(gender0 = 'M' AS INTEGER) AS gender_M, CAST(gender0 = 'F' AS INTEGER) AS gender_F,
    CAST(NOT coalesce(gender0 IN ('M', 'F'), false) AS INTEGER) AS gender_unknown,
    CASE WHEN st IS NOT NULL THEN CAST(st IN ('CA', 'NY', 'TX', 'FL', 'IL') AS INTEGER) END AS major_metro,
    st AS location_state
  FROM fx)"""


def fm_select(rel: str = "fm", places: int | None = 6) -> str:
    def r(c):
        e = f"coalesce(CAST({c} AS DOUBLE), 0.0)"
        return f"{R(e, places)} AS {c}" if places else f"{e} AS {c}"
    return f"SELECT userId, {', '.join(r(c) for c in S.NUMERIC_FEATURES)}, location_state FROM {rel}"


def feature_matrix_sql(cutoff: str | None, adapter: str = "A") -> str:
    return with_ev(fm_select(), adapter, feature_ctes(cutoff))


register("feature_matrix", feature_matrix_sql(CUTOFF_A))(
    lambda spark, sf: X.feature_matrix(ev_a(spark, sf), CUTOFF_A))
register("feature_matrix_nocutoff", feature_matrix_sql(None))(
    lambda spark, sf: X.feature_matrix(ev_a(spark, sf), None))


def _group_sql(cols: list[str], cutoff=CUTOFF_A) -> str:
    sel = ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), 0.0)')} AS {c}" for c in cols)
    return with_ev(f"SELECT userId, {sel} FROM fm", "A", feature_ctes(cutoff))


def _group_q(cols):
    return lambda spark, sf: X.feature_matrix(ev_a(spark, sf), CUTOFF_A).select("userId", *cols)


for _name, _cols in [("feat_temporal", S.FEATURES_TEMPORAL), ("feat_recent_windows", S.FEATURES_RECENT),
                     ("feat_page_counts", S.FEATURES_PAGES), ("feat_engagement_ratios", S.FEATURES_RATIOS),
                     ("feat_listening", S.FEATURES_LISTENING), ("feat_sessions", S.FEATURES_SESSIONS),
                     ("feat_levels", S.FEATURES_LEVELS), ("feat_level_time", S.FEATURES_LEVEL_TIME),
                     ("feat_downgrade", S.FEATURES_DOWNGRADE), ("feat_trends", S.FEATURES_TRENDS),
                     ("feat_decline", S.FEATURES_DECLINE)]:
    register(_name, _group_sql(_cols))(_group_q(_cols))

register("feat_demographics", with_ev(
    "SELECT userId, " + ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), 0.0)')} AS {c}"
                                   for c in S.FEATURES_DEMOGRAPHIC) + ", location_state FROM fm",
    "A", feature_ctes(CUTOFF_A)))(
    lambda spark, sf: X.feature_matrix(ev_a(spark, sf), CUTOFF_A).select("userId", *S.FEATURES_DEMOGRAPHIC,
                                                                       "location_state"))

# Training set = features joined with labels --------------------------------
_LAB_FOR_JOIN = """
lab AS (
  SELECT userId,
    (min(ts) FILTER (WHERE page IN ('Submit Downgrade', 'Downgrade')) IS NOT NULL) AS expl,
    min(ts) FILTER (WHERE level = 'paid') AS first_paid, min(ts) FILTER (WHERE level = 'free') AS first_free,
    max(ts) AS last_activity
  FROM ev GROUP BY userId),
lab2 AS (
  SELECT userId, expl, first_paid, first_free, last_activity,
    {idle} AS idle FROM lab CROSS JOIN (SELECT max(ts) AS dataset_end FROM ev)),
lab3 AS (
  SELECT userId,
    CASE WHEN expl THEN 'explicit'
         WHEN first_free > first_paid AND last_activity > first_free AND idle >= {n} THEN 'subscription_downgrade'
         WHEN idle >= {n} THEN 'inactivity' ELSE 'not_churned' END AS churn_type
  FROM lab2)""".format(idle=days("dataset_end", "last_activity"), n=INACTIVITY_A)


def training_set_sql(how: str = "INNER") -> str:
    ctes = feature_ctes(CUTOFF_A) + "," + _LAB_FOR_JOIN
    body = (fm_select("fm") .replace("FROM fm", "")
            + ", (l.churn_type <> 'not_churned') AS is_churned, l.churn_type AS churn_type "
            + f"FROM fm {how} JOIN lab3 l USING (userId)")
    body = body.replace("SELECT userId,", "SELECT fm.userId AS userId,", 1)
    return with_ev(body, "A", ctes)


def _training(spark, sf, how="inner"):
    ev = ev_a(spark, sf)
    return X.features_with_labels(X.feature_matrix(ev, CUTOFF_A), L.churn_labels(ev, INACTIVITY_A), how)


register("features_labels_inner", training_set_sql("INNER"))(lambda spark, sf: _training(spark, sf, "inner"))
register("features_labels_left", training_set_sql("LEFT"))(lambda spark, sf: _training(spark, sf, "left"))

# Top correlations -----------------------------------------------------------
_CORR_SQL_UNIONS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, CAST(is_churned AS DOUBLE)) AS c FROM ts_" for c in S.NUMERIC_FEATURES)


def _corr_sql() -> str:
    ctes = feature_ctes(CUTOFF_A) + "," + _LAB_FOR_JOIN + """,
ts_ AS (SELECT fm.*, (l.churn_type <> 'not_churned') AS is_churned FROM fm JOIN lab3 l USING (userId)),
fz AS (SELECT userId, is_churned, """ + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}"
                                                  for c in S.NUMERIC_FEATURES) + " FROM ts_),"
    ctes = ctes + "\ncc AS (" + _CORR_SQL_UNIONS.replace("FROM ts_", "FROM fz") + ")"
    body = """
SELECT feature, CAST(round(CAST(corr AS DECIMAL(38, 15)), 6) AS DOUBLE) AS corr, rank FROM (
  SELECT feature, CASE WHEN isnan(c) THEN NULL ELSE c END AS corr,
         row_number() OVER (ORDER BY abs(round(CASE WHEN isnan(c) THEN NULL ELSE c END, 9)) DESC NULLS LAST,
                                     feature) AS rank
  FROM cc) WHERE rank <= 15"""
    return with_ev(body, "A", ctes)


register("feature_label_corr", _corr_sql())(
    lambda spark, sf: X.feature_label_corr(_training(spark, sf, "inner")))

# W1 / W2 / W4 ----------------------------------------------------------------------------
register("first_per_group", with_ev("""
SELECT userId, level, ts, event_id FROM (
  SELECT userId, level, ts, event_id,
         row_number() OVER (PARTITION BY userId, level ORDER BY ts, event_id) AS rn FROM ev) WHERE rn = 1"""))(
    lambda spark, sf: ev_a(spark, sf).groupBy("userId", "level").agg(
        F.min(F.struct("ts", "event_id")).alias("f")).select("userId", "level", "f.ts", "f.event_id"))

register("latest_row", with_ev("""
SELECT userId, last(level ORDER BY ts, event_id) AS level, max(ts) AS ts FROM ev GROUP BY userId"""))(
    lambda spark, sf: ev_a(spark, sf).groupBy("userId").agg(
        F.max(F.struct("ts", "event_id", "level")).alias("l")).select("userId", "l.level", "l.ts"))

register("user_max_broadcast", with_ev("""
SELECT userId, count(*) AS events, count(*) FILTER (WHERE ts >= cref - INTERVAL 7 DAY) AS events_last_7d
FROM (SELECT *, max(ts) OVER (PARTITION BY userId) AS cref FROM ev) GROUP BY userId"""))(
    lambda spark, sf: X.user_max_broadcast(ev_a(spark, sf)).groupBy("userId").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("ts") >= F.col("cref") - F.expr("INTERVAL 7 DAYS")).alias("events_last_7d")))


def _tail_head(spark, sf):
    """Last 7 active days versus the days before, per user (on the day grain)."""
    ev = ev_a(spark, sf)
    day = ev.groupBy("userId", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("de"))
    w = W.partitionBy("userId").orderBy(F.col("d").desc())
    day = day.withColumn("rn", F.row_number().over(w))
    return day.groupBy("userId").agg(F.sum(F.when(F.col("rn") <= 7, F.col("de"))).alias("tail_events"),
                                     F.sum(F.when(F.col("rn") > 7, F.col("de"))).alias("head_events"),
                                     F.count(F.lit(1)).alias("active_days"))


register("tail_head_window", with_ev("""
SELECT userId, CAST(sum(de) FILTER (WHERE rn <= 7) AS BIGINT) AS tail_events,
       CAST(sum(de) FILTER (WHERE rn > 7) AS BIGINT) AS head_events, count(*) AS active_days
FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY d DESC) AS rn
      FROM (SELECT userId, CAST(ts AS DATE) AS d, count(*) AS de FROM ev GROUP BY 1, 2)) GROUP BY userId"""))(
    _tail_head)
