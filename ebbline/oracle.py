"""DuckDB oracle SQL building blocks.

The oracle re-derives everything from the raw tables with plain SQL (a
straightforward ordered-window formulation), so it checks the Spark plans
rather than sharing code with them.
"""
from __future__ import annotations

DAY_US = 86400000000.0

# Adapter A in SQL: canonical, cleaned events as CTE ``ev``.
EV_CTE = """
ev_raw AS (
  SELECT e.event_id, e.user_id, CAST(e.ts AS TIMESTAMP) AS ts, e.value, e.event_type,
         CAST(json_extract(e.props, '$.k') AS INTEGER) AS k
  FROM events e
),
ev_page AS (
  SELECT *,
    CASE
      WHEN event_type = 'view' THEN 'NextSong'
      WHEN event_type = 'click' THEN CASE WHEN k % 4 <= 1 THEN 'Thumbs Up' WHEN k % 4 = 2 THEN 'Thumbs Down'
                                          ELSE 'Add to Playlist' END
      WHEN event_type = 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'Add Friend' ELSE 'Roll Advert' END
      WHEN event_type = 'signup' THEN CASE WHEN k < 10 THEN 'Submit Upgrade' ELSE 'Home' END
      WHEN event_type = 'error' THEN CASE WHEN k >= 97 THEN 'Submit Downgrade' WHEN k >= 94 THEN 'Downgrade'
                                          ELSE 'Help' END
    END AS page0,
    lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM ev_raw
),
ev_sess AS (
  SELECT *,
    CAST(sum(CASE WHEN prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) > 21600000000 THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS BIGINT) AS sseq
  FROM ev_page
),
ev AS (
  SELECT s.event_id,
    CAST(s.user_id AS VARCHAR) AS userId,
    s.ts,
    CASE WHEN s.user_id % 11 <> 0
         THEN TIMESTAMP '2023-12-01 00:00:00' + to_days(CAST((s.user_id * 37) % 45 AS INTEGER)) END AS registration,
    CAST(s.user_id AS VARCHAR) || '-' || CAST(s.sseq AS VARCHAR) AS sessionId,
    coalesce(s.page0, 'Unknown') AS page,
    CASE WHEN s.user_id % 3 = 0 THEN CASE WHEN s.ts < TIMESTAMP '2024-01-12 00:00:00' THEN 'paid' ELSE 'free' END
         WHEN s.user_id % 3 = 1 THEN CASE WHEN s.ts < TIMESTAMP '2024-01-18 00:00:00' THEN 'free' ELSE 'paid' END
         ELSE 'free' END AS level,
    'Logged In' AS auth,
    CASE WHEN s.page0 = 'NextSong' THEN 'PUT' ELSE 'GET' END AS method,
    CASE WHEN s.user_id % 3 = 0 THEN 'M' WHEN s.user_id % 3 = 1 THEN 'F' ELSE 'Unknown' END AS gender,
    coalesce(CASE c.c_nationkey % 7
               WHEN 0 THEN c.c_mktsegment || ', CA' WHEN 1 THEN c.c_mktsegment || ', NY-NJ-PA'
               WHEN 2 THEN c.c_mktsegment || ', TX' WHEN 3 THEN c.c_mktsegment || ', FL'
               WHEN 4 THEN c.c_mktsegment || ', CT' WHEN 5 THEN c.c_mktsegment || ', IL' END,
             'Unknown') AS location,
    CASE WHEN s.page0 = 'NextSong' THEN 'A' || CAST(s.k % 20 AS VARCHAR) END AS artist,
    CASE WHEN s.page0 = 'NextSong' THEN 'S' || CAST(s.k AS VARCHAR) END AS song,
    CASE WHEN s.page0 = 'NextSong' THEN s.value END AS length
  FROM ev_sess s LEFT JOIN customer c ON c.c_custkey = s.user_id
)"""

# Adapter B in SQL.
OV_CTE = """
ov_first AS (SELECT o_custkey, min(CAST(o_orderdate AS TIMESTAMP)) AS first_ts FROM orders GROUP BY 1),
ev AS (
  SELECT o.o_orderkey AS event_id, CAST(o.o_custkey AS VARCHAR) AS userId, CAST(o.o_orderdate AS TIMESTAMP) AS ts,
    f.first_ts - INTERVAL 30 DAY AS registration,
    CAST(o.o_orderkey AS VARCHAR) AS sessionId, 'NextSong' AS page,
    CASE WHEN o.o_orderstatus = 'F' THEN 'paid' ELSE 'free' END AS level,
    'Logged In' AS auth, 'PUT' AS method,
    CASE WHEN o.o_custkey % 3 = 0 THEN 'M' WHEN o.o_custkey % 3 = 1 THEN 'F' ELSE 'Unknown' END AS gender,
    coalesce(CASE c.c_nationkey % 7
               WHEN 0 THEN c.c_mktsegment || ', CA' WHEN 1 THEN c.c_mktsegment || ', NY-NJ-PA'
               WHEN 2 THEN c.c_mktsegment || ', TX' WHEN 3 THEN c.c_mktsegment || ', FL'
               WHEN 4 THEN c.c_mktsegment || ', CT' WHEN 5 THEN c.c_mktsegment || ', IL' END,
             'Unknown') AS location,
    CAST(NULL AS VARCHAR) AS artist, CAST(NULL AS VARCHAR) AS song, o.o_totalprice AS length
  FROM orders o JOIN ov_first f USING (o_custkey) LEFT JOIN customer c ON c.c_custkey = o.o_custkey
)"""


def days(later: str, earlier: str) -> str:
    """Floored whole days between two timestamps, as BIGINT."""
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / {DAY_US}) AS BIGINT)"


def minutes(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 60000000.0)"


def with_ev(body: str, adapter: str = "A", extra_ctes: str = "") -> str:
    cte = EV_CTE if adapter == "A" else OV_CTE
    extra = f",\n{extra_ctes}" if extra_ctes.strip() else ""
    return f"WITH {cte.strip()}{extra}\n{body}"


def R(expr: str, places: int = 6) -> str:
    """Round to 9 places, then to ``places`` - the same two steps as the Spark side, so a value
    whose shortest decimal form and exact binary value straddle a half-way point agrees."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38, 9)), {places}) AS DOUBLE)"


def rounded(sql: str, cols: list[str], doubles: list[str], places: int = 6) -> str:
    """Wrap ``sql`` selecting ``cols`` with doubles rounded to ``places``."""
    sel = ", ".join(f"{R(c, places)} AS {c}" if c in doubles else c for c in cols)
    return f"SELECT {sel} FROM (\n{sql}\n) q_"
