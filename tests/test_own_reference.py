"""Windows that end at each user's own last event, and gap sessions: both without an order or a join of all events."""
import datetime as dt
import random
import re

import pytest
from conftest import make_events
from pyspark.sql import functions as F

from ebbline import schema as S
from ebbline.operators import features as X
from ebbline.operators.sessions import gap_session_seq

BASE = dt.datetime(2024, 1, 1)


def some_events(n=900, users=7, seed=3):
    """Users with different last times; some events exactly at a window's begin."""
    rnd = random.Random(seed)
    rows = [dict(event_id=i, userId=str(rnd.randrange(users)), sessionId=f"s{rnd.randrange(60)}",
                 ts=BASE + dt.timedelta(seconds=rnd.randrange(40 * 86400)), page=rnd.choice(["NextSong", "Home", "Thumbs Up"]))
            for i in range(n)]
    for u in range(users):
        last = max(r["ts"] for r in rows if r["userId"] == str(u))
        for k, days in enumerate(X.WINDOW_DAYS):
            for j, off in enumerate((-1, 0, 0, 1)):
                rows.append(dict(event_id=n + 100 * u + 10 * k + j, userId=str(u), sessionId=f"edge{k}{j}", page="Home",
                                 ts=last - dt.timedelta(days=days) + dt.timedelta(microseconds=off)))
    return rows


def brute(rows, user):
    own = [r for r in rows if r["userId"] == user]
    last = max(r["ts"] for r in own)
    ends = {}
    for r in own:
        ends[r["sessionId"]] = max(ends.get(r["sessionId"], r["ts"]), r["ts"])
    days = {}
    for r in own:
        days[r["ts"].date()] = max(days.get(r["ts"].date(), r["ts"]), r["ts"])
    out = {}
    for n in S.RECENT_WINDOWS:
        begin = last - dt.timedelta(days=n)
        out[f"events_last_{n}d"] = sum(r["ts"] >= begin for r in own)
        out[f"sessions_last_{n}d"] = sum(t >= begin for t in ends.values())
        out[f"days_active_last_{n}d"] = sum(t >= begin for t in days.values())
    return out


@pytest.mark.parametrize("materialize", [True, False])
def test_recent_counts_without_a_cutoff_match_brute_force(spark, materialize):
    rows = some_events()
    got = {r.userId: r for r in X.feature_matrix(make_events(spark, rows), None, materialize=materialize).collect()}
    assert len(got) == 7
    for user, r in got.items():
        want = brute(rows, user)
        assert {k: r[k] for k in want} == want


def test_full_matrix_without_a_cutoff_equals_the_joined_form(spark):
    ev = make_events(spark, some_events(seed=8))
    got = X.feature_matrix(ev, None)
    fine = X._fine_grain(X.user_max_broadcast(ev))              # every event with its own reference time
    u = X._user_grain(fine).select("userId", "cref", *[f"_e{n}" for n in X.WINDOW_DAYS])
    joined = {r.userId: r for r in u.collect()}
    for r in got.collect():
        assert all(r[f"events_last_{n}d"] == joined[r.userId][f"_e{n}"] for n in S.RECENT_WINDOWS)


def test_full_bit_table_changes_no_count(spark, monkeypatch):
    rows = some_events(300, 3)
    ev = make_events(spark, rows)
    whole = X.maybe_in
    monkeypatch.setattr(X, "bit_table", lambda hashes, column: __import__("ebbline.operators.bits", fromlist=["x"]).bit_table(
        hashes, column, 1))
    monkeypatch.setattr(X, "maybe_in", lambda df, table, column, out: whole(df, table, column, out, 1))
    for r in X.feature_matrix(ev, None).collect():
        want = brute(rows, r.userId)
        assert {k: r[k] for k in want} == want


def test_events_meet_the_reference_only_behind_the_bit_table(spark, tmp_path):
    path = str(tmp_path / "ev")
    make_events(spark, some_events()).write.parquet(path)
    ev = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fine = X._fine_grain(ev)
        u, _ = X._own_reference(ev, fine, X._sessions(fine))
        plan = u._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # a scan of userId and ts alone feeds the cut days; the wide scan feeds aggregates only
    assert re.search(r"ReadSchema: struct<userId:string,ts:timestamp>", plan)
    assert "getbit" in plan


def numbered(rows, gap):
    out, last, seq = {}, {}, {}
    for i, user, t in sorted(rows, key=lambda r: (str(r[1]), r[2], r[0])):
        if user not in last or (t - last[user]).total_seconds() > gap:
            seq[user] = seq.get(user, 0) + 1
        last[user] = t
        out[i] = seq[user]
    return out


@pytest.mark.parametrize("gap,chunk,hot_rows", [(3600, None, 10 ** 6), (3600, 600, 10 ** 6), (7, None, 10 ** 6), (0, None, 10 ** 6),
                                                (86400, None, 20), (3600, None, 5)])
def test_gap_sessions_match_brute_force(spark, gap, chunk, hot_rows):
    rnd = random.Random(gap)
    rows = []
    for i in range(1500):
        user = rnd.choice([1, 1, 1, 2, 3])
        at = rnd.choice([0, 1, 2, 9]) * 86400 + rnd.choice([0, gap, 2 * gap, 3 * gap, rnd.randrange(40_000)])
        rows.append((i, user, BASE + dt.timedelta(seconds=at, microseconds=rnd.choice([0, 0, 1]))))
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp").repartition(5)
    got = gap_session_seq(df, "user_id", gap_seconds=gap, chunk_seconds=chunk, hot_rows=hot_rows)
    assert {r.event_id: r.session_seq for r in got.collect()} == numbered(rows, gap)


def test_gap_sessions_keep_rows_without_key_or_time(spark):
    df = spark.createDataFrame([(1, None, BASE), (2, 5, None), (3, 5, BASE)], "event_id long, user_id long, ts timestamp")
    assert sorted((r.event_id, r.session_seq) for r in gap_session_seq(df, "user_id").collect()) == [(1, None), (2, None), (3, 1)]
    assert gap_session_seq(df.limit(0), "user_id").count() == 0


def test_a_burst_of_one_user_stays_where_it_is(spark):
    """A million events of one user in a minute are not exchanged: each task numbers its own rows."""
    n = 1_000_000
    df = (spark.range(0, n, 1, 8).select(F.col("id").alias("event_id"), F.lit(1).alias("user_id"),
                                         F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 60).alias("ts"))
          .union(spark.range(n, n + 50).select("id", F.lit(2), F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 1_000_000))))
    got = gap_session_seq(df, "user_id", gap_seconds=1800)
    sizes = (got.filter("user_id = 1").groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.max("session_seq").alias("s"), F.min("session_seq").alias("lo")).collect())
    assert sum(r.n for r in sizes) == n and len(sizes) == 8
    assert max(r.n for r in sizes) == n // 8
    assert {(r.lo, r.s) for r in sizes} == {(1, 1)}
    assert got.count() == n + 50
