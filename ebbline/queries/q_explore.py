"""A1-A6, A13-A32, K1-K4, J6, J10, U3, U5 exploration queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import INACTIVITY_A, ev_a, register
from ..operators import explore as E
from ..operators import labels as L
from ..operators.prep import reference_current_split
from ..oracle import R, days, minutes, with_ev
from .q_labels import labels_ctes

N = INACTIVITY_A

# user summary (A14) in SQL, CTE ``usum``
USUM = f"""
us_core AS (
  SELECT userId, count(*) AS total_events, min(ts) AS first_activity, max(ts) AS last_activity,
    first(gender ORDER BY ts, event_id) FILTER (WHERE gender IS NOT NULL) AS gender,
    first(location ORDER BY ts, event_id) FILTER (WHERE location IS NOT NULL) AS location,
    first(registration ORDER BY ts, event_id) FILTER (WHERE registration IS NOT NULL) AS registration,
    count(DISTINCT sessionId) AS unique_sessions
  FROM ev GROUP BY userId),
us_mode AS (SELECT userId, first(level ORDER BY n DESC, level) AS primary_level
            FROM (SELECT userId, level, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1),
usum AS (
  SELECT c.userId, total_events, first_activity, last_activity, unique_sessions, primary_level, gender, location,
    registration, {days('last_activity', 'first_activity')} AS activity_span_days,
    total_events / ({days('last_activity', 'first_activity')} + 1) AS events_per_day,
    {days('de.dataset_end', 'registration')} AS days_since_registration
  FROM us_core c JOIN us_mode USING (userId) CROSS JOIN (SELECT max(ts) AS dataset_end FROM ev) de)"""


def _users(spark, sf):
    return E.user_summary(ev_a(spark, sf))


def _labels(ev):
    return L.churn_labels(ev, N)


# A1 ----------------------------------------------------------------------------
register("data_overview", with_ev(f"""
SELECT count(*) AS total_events, count(DISTINCT userId) AS unique_users, min(ts) AS start, max(ts) AS "end",
  {days('max(ts)', 'min(ts)')} AS duration_days, count(DISTINCT sessionId) AS unique_sessions,
  count(*) FILTER (WHERE page = 'NextSong') AS song_events
FROM ev"""))(lambda spark, sf: E.data_overview(ev_a(spark, sf)))

# A2 ----------------------------------------------------------------------------
_VC = ["page", "level", "gender", "auth"]
register("value_counts", with_ev(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM ev "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in _VC)))(
    lambda spark, sf: E.value_counts(ev_a(spark, sf), _VC))

# A3 ----------------------------------------------------------------------------
register("value_share", with_ev(f"""
SELECT page, count, {R('count * 100.0 / total', 2)} AS percent
FROM (SELECT page, count(*) AS count, sum(count(*)) OVER () AS total FROM ev WHERE page IS NOT NULL GROUP BY page)"""))(
    lambda spark, sf: E.value_share(ev_a(spark, sf), "page"))

# A4 ----------------------------------------------------------------------------
_EV_COLS = ["event_id", "userId", "ts", "registration", "sessionId", "page", "level", "auth", "method", "gender",
            "location", "artist", "song", "length"]
register("missing_values", with_ev(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM ev" for c in _EV_COLS)))(
    lambda spark, sf: E.missing_values(ev_a(spark, sf).select(*_EV_COLS)))


# A5 ----------------------------------------------------------------------------
def _user_behavior(spark, sf):
    ub = E.user_behavior(ev_a(spark, sf))
    return ub.withColumn("page_breakdown", F.to_json("page_breakdown"))


register("user_behavior", with_ev(f"""
SELECT c.userId, first_activity, last_activity, total_events, unique_sessions,
  pb.page_breakdown, primary_level, gender, location, registration AS registration_date,
  {days('last_activity', 'first_activity')} AS activity_span_days,
  {days('last_activity', 'registration')} AS days_since_registration
FROM us_core c JOIN us_mode USING (userId)
JOIN (SELECT userId, '{{' || string_agg('"' || page || '":' || CAST(n AS VARCHAR), ',' ORDER BY page) || '}}'
             AS page_breakdown
      FROM (SELECT userId, page, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY userId) pb USING (userId)""",
    "A", USUM))(_user_behavior)

# A6 ----------------------------------------------------------------------------
register("behavior_summary", with_ev(f"""
SELECT {R('avg(total_events)')} AS avg_events_per_user, {R('avg(activity_span_days)')} AS avg_activity_span,
       count(*) FILTER (WHERE total_events > 100) AS users_over_100_events FROM usum""", "A", USUM))(
    lambda spark, sf: E.behavior_summary(E.user_behavior(ev_a(spark, sf))))

# A13 ---------------------------------------------------------------------------
_CATS = {
    "Music Engagement": "('NextSong', 'Thumbs Up', 'Thumbs Down', 'Add to Playlist', 'Add Friend')",
    "Navigation": "('Home', 'Help', 'Settings', 'About')",
    "Subscription": "('Submit Downgrade', 'Downgrade', 'Submit Registration', 'Submit Upgrade')",
    "Authentication": "('Login', 'Logout', 'Register')",
}
_ALL_LISTED = "(" + ", ".join(v.strip("()") for v in _CATS.values()) + ")"
register("event_categories", with_ev(" UNION ALL ".join(
    [f"SELECT '{k}' AS category, count(*) FILTER (WHERE page IN {v}) AS events FROM ev" for k, v in _CATS.items()]
    + [f"SELECT 'Other', count(*) FILTER (WHERE page IS NULL OR page NOT IN {_ALL_LISTED}) FROM ev"])))(
    lambda spark, sf: E.event_categories(ev_a(spark, sf)))

# U5 ----------------------------------------------------------------------------
register("other_events", with_ev(f"""
SELECT page, count(*) AS events FROM ev WHERE page IS NULL OR page NOT IN {_ALL_LISTED} GROUP BY page"""))(
    lambda spark, sf: E.other_events(ev_a(spark, sf)))

# A14 ---------------------------------------------------------------------------
register("user_summary", with_ev(f"""
SELECT userId, total_events, first_activity, last_activity, unique_sessions, primary_level, gender, location,
  registration, activity_span_days, {R('events_per_day')} AS events_per_day, days_since_registration
FROM usum""", "A", USUM))(_users)

# A15 ---------------------------------------------------------------------------
_SEG = ("CASE WHEN total_events < 100 THEN 'Low Activity' WHEN total_events < 1000 THEN 'Medium Activity' "
        "ELSE 'High Activity' END")
register("activity_segments", with_ev(f"""
SELECT {_SEG} AS activity_segment, count(*) AS users, {R('avg(total_events)')} AS avg_events
FROM usum GROUP BY 1""", "A", USUM))(lambda spark, sf: E.activity_segments(_users(spark, sf)))


# A16 ---------------------------------------------------------------------------
def _xtab_sql(row_expr: str, row: str, src: str, ctes: str) -> str:
    return with_ev(f"""
SELECT {row}, primary_level, count, {R('count * 100.0 / sum(count) OVER (PARTITION BY ' + row + ')')} AS pct
FROM (SELECT {row_expr} AS {row}, primary_level, count(*) AS count FROM {src} GROUP BY 1, 2)""", "A", ctes)


register("crosstab_gender_level", _xtab_sql("gender", "gender", "usum", USUM))(
    lambda spark, sf: E.crosstab_share(_users(spark, sf), "gender", "primary_level"))
register("crosstab_segment_level", _xtab_sql(_SEG, "activity_segment", "usum", USUM))(
    lambda spark, sf: E.crosstab_share(
        _users(spark, sf).withColumn("activity_segment", E.activity_segment("total_events")),
        "activity_segment", "primary_level"))


def _xtab_churn(spark, sf):
    ev = ev_a(spark, sf)
    u = E.user_summary(ev).join(_labels(ev).select("userId", "is_churned"), "userId")
    u = u.withColumn("churn_status", F.when(F.col("is_churned"), "Churned").otherwise("Active"))
    return E.crosstab_share(u, "churn_status", "primary_level")


register("crosstab_churn_level", _xtab_sql(
    "CASE WHEN lab.is_churned THEN 'Churned' ELSE 'Active' END", "churn_status",
    "usum JOIN lab USING (userId)", USUM + "," + labels_ctes(N)).replace(
    "primary_level, count(*) AS count FROM usum", "usum.primary_level, count(*) AS count FROM usum"))(_xtab_churn)


# A17 ---------------------------------------------------------------------------
def _churn_by_level(spark, sf):
    ev = ev_a(spark, sf)
    return E.churn_by_level(E.user_summary(ev), _labels(ev))


register("churn_by_level", with_ev(f"""
SELECT primary_level, users, churned, {R('churn_rate')} AS churn_rate,
  (primary_level = first(primary_level) OVER (ORDER BY churn_rate DESC, primary_level
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
   AND max(churn_rate) OVER () > 0) AS is_highest
FROM (SELECT usum.primary_level, count(*) AS users, count(*) FILTER (WHERE lab.is_churned) AS churned,
             count(*) FILTER (WHERE lab.is_churned) / count(*) AS churn_rate
      FROM usum LEFT JOIN lab USING (userId) GROUP BY 1)""", "A", USUM + "," + labels_ctes(N)))(_churn_by_level)

# A18 ---------------------------------------------------------------------------
_SONGS = "(SELECT * FROM ev WHERE page = 'NextSong' AND artist IS NOT NULL AND song IS NOT NULL AND length IS NOT NULL)"
register("song_overview", with_ev(f"""
SELECT count(*) AS plays, count(DISTINCT artist) AS unique_artists, count(DISTINCT song) AS unique_songs,
  {R('avg(length)')} AS avg_length,
  {R('count(*) / CAST((SELECT ' + days('max(ts)', 'min(ts)') + ' FROM ev) AS DOUBLE)')} AS plays_per_day
FROM {_SONGS} s"""))(lambda spark, sf: E.song_overview(ev_a(spark, sf)))

# A19 ---------------------------------------------------------------------------
register("user_music", with_ev(f"""
SELECT userId, count(DISTINCT artist) AS unique_artists, count(DISTINCT song) AS unique_songs,
  count(length) AS songs_played, {R('avg(length)')} AS avg_song_length, {R('sum(length)')} AS total_listening_time,
  {R('count(DISTINCT artist) / count(length)')} AS artist_diversity,
  {R('count(DISTINCT song) / count(length)')} AS song_diversity
FROM {_SONGS} s GROUP BY userId"""))(lambda spark, sf: E.user_music(ev_a(spark, sf)))

# A20 ---------------------------------------------------------------------------
register("user_ratings", with_ev(f"""
SELECT userId, count(*) FILTER (WHERE page = 'Thumbs Up') AS thumbs_up,
  count(*) FILTER (WHERE page = 'Thumbs Down') AS thumbs_down, count(*) AS total_ratings,
  {R("count(*) FILTER (WHERE page = 'Thumbs Up') / count(*)")} AS positive_ratio
FROM ev WHERE page IN ('Thumbs Up', 'Thumbs Down') GROUP BY userId"""))(
    lambda spark, sf: E.user_ratings(ev_a(spark, sf)))

# A21-A24 -----------------------------------------------------------------------
register("daily_stats", with_ev(f"""
SELECT CAST(ts AS DATE) AS date, count(DISTINCT userId) AS unique_users, count(*) AS total_events,
  count(DISTINCT sessionId) AS unique_sessions, count(*) FILTER (WHERE page = 'NextSong') AS song_plays,
  {R('count(*) / count(DISTINCT userId)')} AS events_per_user,
  {R("count(*) FILTER (WHERE page = 'NextSong') / count(DISTINCT userId)")} AS songs_per_user
FROM ev GROUP BY 1"""))(lambda spark, sf: E.daily_stats(ev_a(spark, sf)))

register("hourly_stats", with_ev("""
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(DISTINCT userId) AS unique_users, count(*) AS total_events
FROM ev GROUP BY 1"""))(lambda spark, sf: E.hourly_stats(ev_a(spark, sf)))

_CAL = ("(VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'), "
        "(6, 'Saturday'), (7, 'Sunday')) cal(dow, day_of_week)")
register("dow_stats", with_ev(f"""
SELECT cal.dow, cal.day_of_week, t.unique_users, t.total_events
FROM {_CAL} LEFT JOIN (SELECT dayname(ts) AS day_of_week, count(DISTINCT userId) AS unique_users,
                              count(*) AS total_events FROM ev GROUP BY 1) t USING (day_of_week)"""))(
    lambda spark, sf: E.dow_stats(ev_a(spark, sf)))

register("weekly_stats", with_ev("""
SELECT CAST(weekofyear(ts) AS INTEGER) AS week, count(DISTINCT userId) AS unique_users, count(*) AS total_events
FROM ev GROUP BY 1"""))(lambda spark, sf: E.weekly_stats(ev_a(spark, sf)))


# K4 ----------------------------------------------------------------------------
def _argmax(spark, sf):
    ev = ev_a(spark, sf)
    d = E.argmax_argmin(E.daily_stats(ev), "date", dimension="day")
    h = E.argmax_argmin(E.hourly_stats(ev), "hour")
    w = E.argmax_argmin(E.dow_stats(ev), "day_of_week", order_key="dow", dimension="weekday")
    return d.unionByName(h).unionByName(w)


def _arg_sql(dim, key, src, okey=None):
    okey = okey or key
    return (f"SELECT '{dim}' AS dimension, first(CAST({key} AS VARCHAR) ORDER BY total_events DESC, {okey}) AS peak_key,"
            f" max(total_events) AS peak_value, first(CAST({key} AS VARCHAR) ORDER BY total_events, {okey}) AS low_key,"
            f" min(total_events) AS low_value FROM {src} WHERE total_events IS NOT NULL")


register("argmax_argmin", with_ev(" UNION ALL ".join([
    _arg_sql("day", "d", "(SELECT CAST(ts AS DATE) AS d, count(*) AS total_events FROM ev GROUP BY 1)"),
    _arg_sql("hour", "h", "(SELECT CAST(hour(ts) AS INTEGER) AS h, count(*) AS total_events FROM ev GROUP BY 1)"),
    _arg_sql("weekday", "day_of_week", f"(SELECT cal.dow, cal.day_of_week, t.total_events FROM {_CAL} LEFT JOIN "
             "(SELECT dayname(ts) AS day_of_week, count(*) AS total_events FROM ev GROUP BY 1) t USING (day_of_week))",
             "dow")])))(_argmax)

# A25 ---------------------------------------------------------------------------
_SESS = f"""
ses AS (SELECT sessionId, count(*) AS events_count, min(ts) AS start_time, max(ts) AS end_time,
               first(userId ORDER BY ts, event_id) AS userId,
               count(*) FILTER (WHERE page = 'NextSong') AS songs_played,
               {minutes('min(ts)', 'max(ts)')} AS duration_minutes
        FROM ev WHERE sessionId IS NOT NULL GROUP BY sessionId)"""
register("session_summary", with_ev(f"""
SELECT sessionId, events_count, start_time, end_time, userId, songs_played, {R('duration_minutes')} AS duration_minutes
FROM ses""", "A", _SESS))(lambda spark, sf: E.session_summary(ev_a(spark, sf)))
register("session_stats", with_ev(f"""
SELECT count(*) AS total_sessions, {R('avg(duration_minutes)')} AS avg_duration_minutes,
  {R('avg(events_count)')} AS avg_events, {R('avg(songs_played)')} AS avg_songs,
  {R('max(duration_minutes)')} AS max_duration_minutes FROM ses""", "A", _SESS))(
    lambda spark, sf: E.session_stats(E.session_summary(ev_a(spark, sf))))

# A26 ---------------------------------------------------------------------------
_D = days("de.dataset_end", "l.last")
register("recency_buckets", with_ev(f"""
SELECT count(*) FILTER (WHERE {_D} <= 7) AS active_last_7d, count(*) FILTER (WHERE {_D} <= 30) AS active_last_30d,
       count(*) FILTER (WHERE {_D} <= 60) AS active_last_60d, count(*) AS users
FROM (SELECT userId, max(ts) AS last FROM ev GROUP BY 1) l CROSS JOIN (SELECT max(ts) AS dataset_end FROM ev) de"""))(
    lambda spark, sf: E.recency_buckets(ev_a(spark, sf)))

# A27 ---------------------------------------------------------------------------
register("downgrade_users", with_ev("""
SELECT count(*) FILTER (WHERE page LIKE '%Downgrade%') AS downgrade_events,
       count(DISTINCT userId) FILTER (WHERE page LIKE '%Downgrade%') AS downgrade_users,
       count(DISTINCT userId) FILTER (WHERE page = 'Submit Downgrade') AS submit_downgrade_users FROM ev"""))(
    lambda spark, sf: E.downgrade_users(ev_a(spark, sf)))

# A28 ---------------------------------------------------------------------------
register("level_transition_users", with_ev("""
SELECT userId, count(DISTINCT level) AS n_levels FROM ev GROUP BY userId HAVING count(DISTINCT level) > 1"""))(
    lambda spark, sf: E.level_transition_users(ev_a(spark, sf)))

# A29 ---------------------------------------------------------------------------
_RISK = """
rk AS (
  SELECT usum.userId, f.has_downgrade, f.nlev > 1 AS level_changes, total_events < 100 AS low_activity,
         activity_span_days < 7 AS short_tenure,
         CAST(f.has_downgrade AS INTEGER) + CAST(f.nlev > 1 AS INTEGER) + CAST(total_events < 100 AS INTEGER)
           + CAST(activity_span_days < 7 AS INTEGER) AS risk_score
  FROM usum JOIN (SELECT userId, bool_or(page LIKE '%Downgrade%') AS has_downgrade, count(DISTINCT level) AS nlev
                  FROM ev GROUP BY 1) f USING (userId)),
rkc AS (SELECT *, CASE WHEN risk_score >= 3 THEN 'High Risk' WHEN risk_score >= 2 THEN 'Medium Risk'
                       WHEN risk_score >= 1 THEN 'Low Risk' ELSE 'No Risk' END AS risk_category FROM rk)"""
register("risk_factors", with_ev("SELECT * FROM rkc", "A", USUM + "," + _RISK))(
    lambda spark, sf: E.risk_factors(ev_a(spark, sf)))
register("risk_distribution", with_ev("SELECT risk_category, count(*) AS users FROM rkc GROUP BY 1", "A",
                                      USUM + "," + _RISK))(
    lambda spark, sf: E.risk_distribution(E.risk_factors(ev_a(spark, sf))))


# A30 ---------------------------------------------------------------------------
def _cva(spark, sf):
    ev = ev_a(spark, sf)
    return E.churned_vs_active(E.user_summary(ev), _labels(ev))


register("churned_vs_active", with_ev(" UNION ALL ".join(
    f"""SELECT '{m}' AS metric, {R(f'avg(usum.{m}) FILTER (WHERE lab.is_churned)')} AS churned_avg,
  {R(f'avg(usum.{m}) FILTER (WHERE NOT lab.is_churned)')} AS active_avg,
  {R(f'coalesce(CASE WHEN avg(usum.{m}) FILTER (WHERE NOT lab.is_churned) > 0 THEN (avg(usum.{m}) FILTER (WHERE lab.is_churned) - avg(usum.{m}) FILTER (WHERE NOT lab.is_churned)) / avg(usum.{m}) FILTER (WHERE NOT lab.is_churned) * 100 END, 0.0)')} AS difference_pct
FROM usum JOIN lab USING (userId)""" for m in E.COMPARE_METRICS), "A", USUM + "," + labels_ctes(N)))(_cva)

# A31 ---------------------------------------------------------------------------
register("key_medians", with_ev(f"""
SELECT {R('quantile_cont(total_events, 0.5)')} AS median_events, {R('avg(activity_span_days)')} AS avg_activity_span,
  max(total_events) AS max_events, count(registration) AS registered_users,
  {R('count(registration) * 100.0 / count(*)')} AS registered_pct FROM usum""", "A", USUM))(
    lambda spark, sf: E.key_medians(_users(spark, sf)))


# A32 ---------------------------------------------------------------------------
def _hist_sql(values_sql: str, col: str, bins: int) -> str:
    ctes = f"""
hv AS (SELECT CAST(v AS DOUBLE) AS v FROM ({values_sql}) x_ WHERE v IS NOT NULL AND NOT isnan(CAST(v AS DOUBLE))),
hr AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hv),
hg AS (SELECT i AS bin, CAST(i AS DOUBLE) * ((hi - lo) / {float(bins)}) + lo AS bin_lo,
              CASE WHEN i = {bins - 1} THEN hi ELSE CAST(i + 1 AS DOUBLE) * ((hi - lo) / {float(bins)}) + lo END AS bin_hi
       FROM hr, range(0, {bins}) t(i))"""
    body = f"""
SELECT CAST(hg.bin AS INTEGER) AS bin, {R('hg.bin_lo')} AS bin_lo, {R('hg.bin_hi')} AS bin_hi,
  count(hv.v) AS count, '{col}' AS "column"
FROM hg LEFT JOIN hv ON hv.v >= hg.bin_lo AND (hv.v < hg.bin_hi OR (hg.bin = {bins - 1} AND hv.v <= hg.bin_hi))
GROUP BY 1, 2, 3"""
    return ctes, body


def _register_hist(name, values_sql, extra, col, bins, spark_fn):
    ctes, body = _hist_sql(values_sql, col, bins)
    register(name, with_ev(body, "A", (extra + "," if extra else "") + ctes))(spark_fn)


_register_hist("histogram_user_events", "SELECT total_events AS v FROM usum", USUM, "total_events", 20,
               lambda spark, sf: E.histogram(_users(spark, sf), "total_events", 20))
_register_hist("histogram_song_length", "SELECT length AS v FROM ev WHERE page = 'NextSong' AND artist IS NOT NULL "
               "AND song IS NOT NULL AND length IS NOT NULL", "", "length", 50,
               lambda spark, sf: E.histogram(E.complete_songs(ev_a(spark, sf)), "length", 50))
_register_hist("histogram_events_per_day", "SELECT events_per_day AS v FROM usum", USUM, "events_per_day", 30,
               lambda spark, sf: E.histogram(_users(spark, sf), "events_per_day", 30))

# K1 ----------------------------------------------------------------------------
register("sort_events", with_ev("SELECT userId, ts, event_id, page FROM ev"))(
    lambda spark, sf: E.sort_events(ev_a(spark, sf)).select("userId", "ts", "event_id", "page"))


# K2 / K3 -----------------------------------------------------------------------
def _top_sql(cols: list[str], src: str, k: int, dim: str) -> str:
    cl = ", ".join(cols)
    order = ", ".join(f"{c} ASC" for c in cols)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT {cl}, count, rank, '{dim}' AS dimension FROM (SELECT {cl}, count, row_number() OVER "
            f"(ORDER BY count DESC, {order}) AS rank FROM (SELECT {cl}, count(*) AS count FROM {src} "
            f"WHERE {notnull} GROUP BY {cl})) WHERE rank <= {k}")


register("top_pages", with_ev(_top_sql(["page"], "ev", 15, "page")))(
    lambda spark, sf: E.top_k(ev_a(spark, sf), ["page"], 15))
register("top_artists", with_ev(_top_sql(["artist"], _SONGS + " s", 10, "artist")))(
    lambda spark, sf: E.top_k(E.complete_songs(ev_a(spark, sf)), ["artist"], 10))
register("top_songs", with_ev(_top_sql(["artist", "song"], _SONGS + " s", 10, "artist")))(
    lambda spark, sf: E.top_k(E.complete_songs(ev_a(spark, sf)), ["artist", "song"], 10))
register("top_locations", with_ev(_top_sql(["location"], "usum", 10, "location"), "A", USUM))(
    lambda spark, sf: E.top_k(_users(spark, sf), ["location"], 10))
register("top_states", with_ev(_top_sql(
    ["state"], "(SELECT CASE WHEN location IS NULL OR location = 'Unknown' THEN 'Unknown' "
               "WHEN len(string_split(location, ', ')) > 1 THEN string_split(location, ', ')[-1] "
               "ELSE 'Unknown' END AS state FROM usum) st", 10, "state"), "A", USUM))(
    lambda spark, sf: E.top_k(E.user_states(_users(spark, sf)), ["state"], 10))


# J6 ----------------------------------------------------------------------------
def _membership(spark, sf):
    ev = ev_a(spark, sf)
    users = E.user_summary(ev).select("userId", "total_events")
    dg = ev.filter(E.contains_downgrade())
    return L.membership_flag(users, dg, "has_downgrade")


register("membership_flag", with_ev("""
SELECT userId, total_events, userId IN (SELECT userId FROM ev WHERE page LIKE '%Downgrade%') AS has_downgrade
FROM usum""", "A", USUM))(_membership)


# U3 ----------------------------------------------------------------------------
def _cat_union(spark, sf):
    s = reference_current_split(ev_a(spark, sf))
    return E.category_union(s.filter(F.col("side") == "reference"), s.filter(F.col("side") == "current"), "page")


register("category_union", with_ev("""
SELECT page FROM ev WHERE ts <= (SELECT make_timestamp(CAST(floor(quantile_cont(epoch_us(ts), 0.7)) AS BIGINT)) FROM ev)
UNION
SELECT page FROM ev WHERE ts > (SELECT make_timestamp(CAST(floor(quantile_cont(epoch_us(ts), 0.7)) AS BIGINT)) FROM ev)"""))(
    _cat_union)
