"""A7-A12 churn labels and their joins."""
from __future__ import annotations

from ..catalog import CUTOFF_A, INACTIVITY_A, INACTIVITY_B, ev_a, ev_b, register  # noqa: F401
from ..operators import labels as L
from ..oracle import R, days, with_ev

EXPL = "page IN ('Submit Downgrade', 'Downgrade')"


def labels_ctes(n: int) -> str:
    body = f"""
u AS (
  SELECT userId,
    min(ts) FILTER (WHERE {EXPL}) AS explicit_ts,
    first(page ORDER BY ts, event_id) FILTER (WHERE {EXPL}) AS explicit_page,
    min(ts) FILTER (WHERE level = 'paid') AS first_paid,
    min(ts) FILTER (WHERE level = 'free') AS first_free,
    min(ts) AS first_activity, max(ts) AS last_activity, count(*) AS total_events,
    first(registration ORDER BY ts, event_id) FILTER (WHERE registration IS NOT NULL) AS registration,
    first(gender ORDER BY ts, event_id) FILTER (WHERE gender IS NOT NULL) AS gender,
    first(location ORDER BY ts, event_id) FILTER (WHERE location IS NOT NULL) AS location
  FROM ev GROUP BY userId),
lv AS (SELECT userId, level, count(*) AS n FROM ev GROUP BY 1, 2),
md AS (SELECT userId, first(level ORDER BY n DESC, level) AS primary_level FROM lv GROUP BY 1),
de AS (SELECT max(ts) AS dataset_end FROM ev),
x AS (
  SELECT u.*, md.primary_level, {days('de.dataset_end', 'u.last_activity')} AS idle
  FROM u JOIN md USING (userId) CROSS JOIN de),
y AS (
  SELECT *, (first_free > first_paid AND last_activity > first_free AND idle >= {n}) AS sub FROM x)"""
    sel = f"""
, lab AS (SELECT userId,
  CASE WHEN explicit_ts IS NOT NULL THEN explicit_ts WHEN sub THEN first_free
       WHEN idle >= {n} THEN last_activity END AS churn_timestamp,
  CASE WHEN explicit_ts IS NOT NULL THEN explicit_page END AS churn_event,
  CASE WHEN explicit_ts IS NOT NULL THEN 'explicit' WHEN sub THEN 'subscription_downgrade'
       WHEN idle >= {n} THEN 'inactivity' ELSE 'not_churned' END AS churn_type,
  (explicit_ts IS NOT NULL OR coalesce(sub, false) OR idle >= {n}) AS is_churned,
  first_activity, last_activity, total_events, primary_level, registration, gender, location,
  {days('last_activity', 'first_activity')} AS activity_span_days,
  {days('last_activity', 'registration')} AS days_since_registration
FROM y)"""
    return body + sel


def _labels_sql(n: int, adapter: str = "A") -> str:
    return with_ev("SELECT * FROM lab", adapter, labels_ctes(n))


register("churn_labels", _labels_sql(INACTIVITY_A))(
    lambda spark, sf: L.churn_labels(ev_a(spark, sf), INACTIVITY_A))
register("churn_labels_setwise", _labels_sql(INACTIVITY_A))(
    lambda spark, sf: L.churn_labels_setwise(ev_a(spark, sf), INACTIVITY_A))
register("churn_labels_orders", _labels_sql(INACTIVITY_B, "B"))(
    lambda spark, sf: L.churn_labels(ev_b(spark, sf), INACTIVITY_B))

register("explicit_churn", with_ev(f"""
SELECT userId, min(ts) AS churn_timestamp, first(page ORDER BY ts, event_id) AS churn_event,
       'explicit' AS churn_type
FROM ev WHERE {EXPL} GROUP BY userId"""))(lambda spark, sf: L.explicit_churn(ev_a(spark, sf)))

_SUB_SQL = """
s AS (SELECT userId, min(ts) FILTER (WHERE level = 'paid') AS first_paid,
             min(ts) FILTER (WHERE level = 'free') AS first_free, max(ts) AS last_activity
      FROM ev GROUP BY userId),
de AS (SELECT max(ts) AS dataset_end FROM ev)"""


def _sub_sql(n, adapter):
    return with_ev(f"""
SELECT userId, first_free AS churn_timestamp, 'subscription_downgrade' AS churn_type,
       {days('dataset_end', 'last_activity')} AS days_inactive
FROM s CROSS JOIN de
WHERE first_free > first_paid AND last_activity > first_free
  AND {days('dataset_end', 'last_activity')} >= {n}""", adapter, _SUB_SQL)


register("subscription_churn", _sub_sql(INACTIVITY_A, "A"))(
    lambda spark, sf: L.subscription_churn(ev_a(spark, sf), INACTIVITY_A))
register("subscription_churn_orders", _sub_sql(INACTIVITY_B, "B"))(
    lambda spark, sf: L.subscription_churn(ev_b(spark, sf), INACTIVITY_B))


def _inact_sql(n, adapter):
    return with_ev(f"""
SELECT userId, last_activity AS churn_timestamp, 'inactivity' AS churn_type,
       {days('dataset_end', 'last_activity')} AS days_inactive
FROM (SELECT userId, max(ts) AS last_activity FROM ev GROUP BY userId) CROSS JOIN (SELECT max(ts) AS dataset_end FROM ev)
WHERE {days('dataset_end', 'last_activity')} >= {n}""", adapter)


register("inactivity_churn", _inact_sql(INACTIVITY_A, "A"))(
    lambda spark, sf: L.inactivity_churn(ev_a(spark, sf), INACTIVITY_A))
register("inactivity_churn_orders", _inact_sql(INACTIVITY_B, "B"))(
    lambda spark, sf: L.inactivity_churn(ev_b(spark, sf), INACTIVITY_B))

register("user_metadata", with_ev(f"""
SELECT u.userId, first_activity, last_activity, total_events, primary_level, registration, gender, location,
  {days('last_activity', 'first_activity')} AS activity_span_days,
  {days('last_activity', 'registration')} AS days_since_registration
FROM (SELECT userId, min(ts) AS first_activity, max(ts) AS last_activity, count(*) AS total_events,
    first(registration ORDER BY ts, event_id) FILTER (WHERE registration IS NOT NULL) AS registration,
    first(gender ORDER BY ts, event_id) FILTER (WHERE gender IS NOT NULL) AS gender,
    first(location ORDER BY ts, event_id) FILTER (WHERE location IS NOT NULL) AS location
  FROM ev GROUP BY userId) u
JOIN (SELECT userId, first(level ORDER BY n DESC, level) AS primary_level
      FROM (SELECT userId, level, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1) m USING (userId)"""))(
    lambda spark, sf: L.user_metadata(ev_a(spark, sf)))

_STATS_SQL = """
SELECT 'all' AS dimension, CAST(NULL AS VARCHAR) AS value, count(*) AS users,
       CAST(sum(CAST(is_churned AS INTEGER)) AS BIGINT) AS churned,
       sum(CAST(is_churned AS INTEGER)) / count(*) AS churn_rate FROM lab
UNION ALL
SELECT 'churn_type', churn_type, count(*), CAST(sum(CAST(is_churned AS INTEGER)) AS BIGINT),
       sum(CAST(is_churned AS INTEGER)) / count(*) FROM lab GROUP BY churn_type
UNION ALL
SELECT 'primary_level', primary_level, count(*), CAST(sum(CAST(is_churned AS INTEGER)) AS BIGINT),
       sum(CAST(is_churned AS INTEGER)) / count(*) FROM lab GROUP BY primary_level
UNION ALL
SELECT 'gender', gender, count(*), CAST(sum(CAST(is_churned AS INTEGER)) AS BIGINT),
       sum(CAST(is_churned AS INTEGER)) / count(*) FROM lab GROUP BY gender"""
_STATS_SQL = with_ev(f"SELECT dimension, value, users, churned, {R('churn_rate')} AS churn_rate FROM ({_STATS_SQL}) q_",
                     "A", labels_ctes(INACTIVITY_A))

register("churn_statistics", _STATS_SQL)(
    lambda spark, sf: L.churn_statistics(L.churn_labels(ev_a(spark, sf), INACTIVITY_A)))
