"""Users' first values, modal level and labels against plain Python, and events combined by hash before any sort."""
from conftest import make_events
from pyspark.sql import functions as F

from ebbline.operators import explore as E
from ebbline.operators import labels as L
from ebbline.operators.sessions import gap_session_seq


def events(spark):
    at = "2024-01-0{} 00:00:00".format
    rows = [dict(userId="a", ts=at(1), event_id=5, gender=None, location="L5", level="paid"),
            dict(userId="a", ts=at(1), event_id=4, gender="F", location=None, level="free"),
            dict(userId="a", ts=at(1), event_id=-7, gender=None, location="L-7", level="free", page="Downgrade"),
            dict(userId="a", ts=at(2), event_id=-9, gender="M", location="L0", level="paid", page="Submit Downgrade"),
            dict(userId="b", ts=at(3), event_id=2**63 - 1, gender="M", location="high", level="paid"),
            dict(userId="b", ts=at(3), event_id=-2**63, gender="F", location="low", level="paid"),
            dict(userId="c", ts=at(2), event_id=1, gender=None, location=None, level=None)]
    return make_events(spark, rows)


def test_first_values_and_modal_level(spark):
    ev = events(spark)
    want = {"a": (4, "free", "F", "L-7"), "b": (2, "paid", "F", "low"), "c": (1, None, None, None)}
    for got in (E.user_summary(ev), L.user_metadata(ev), L.churn_labels(ev)):
        assert {r.userId: (r.total_events, r.primary_level, r.gender, r.location) for r in got.collect()} == want
    churned = {r.userId: r.churn_event for r in L.churn_labels(ev).collect()}
    assert churned == {"a": "Downgrade", "b": None, "c": None}


def test_events_are_not_sorted_before_they_are_combined(spark):
    ev = events(spark).withColumn("location", F.col("location"))
    for df in (E._user_core(ev), L.user_metadata(ev), L.user_groups(ev)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        first = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
        assert "HashAggregate" in first and "Object" not in first, plan


def test_many_chunks_are_not_broadcast(spark):
    """A table of chunks is small as a file and large in memory: its rows decide."""
    df = spark.range(3000).selectExpr("id % 50 AS user_id", "timestamp_seconds(1704067200 + id * 7200) AS ts", "id AS event_id")
    few, many = (gap_session_seq(df, "user_id", broadcast_rows=n) for n in (10**6, 100))
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, many.collect()))
    assert got == sorted(map(tuple, few.collect())) and len(got) == 3000
