from pyspark.sql import functions as F

from conftest import make_events
from ebbline.operators import labels as L


def _lab(df, n=30):
    return {r.userId: r for r in L.churn_labels(df, n).collect()}


def test_priority_and_subscription_paid_free_paid(spark):
    rows = [
        # u1: explicit (plain Downgrade page counts too)
        dict(event_id=1, userId="u1", ts="2024-01-01 00:00:00", page="Downgrade"),
        dict(event_id=2, userId="u1", ts="2024-01-02 00:00:00"),
        # u2: paid -> free -> paid, idle long: subscription churn at first free
        dict(event_id=3, userId="u2", ts="2024-01-01 00:00:00", level="paid"),
        dict(event_id=4, userId="u2", ts="2024-01-02 00:00:00", level="free"),
        dict(event_id=5, userId="u2", ts="2024-01-03 00:00:00", level="paid"),
        # u3: only inactivity
        dict(event_id=6, userId="u3", ts="2024-01-01 00:00:00"),
        # u4: active at the end
        dict(event_id=7, userId="u4", ts="2024-03-01 00:00:00"),
        # blank id is a user
        dict(event_id=8, userId="", ts="2024-03-01 00:00:00"),
    ]
    lab = _lab(make_events(spark, rows))
    assert lab["u1"].churn_type == "explicit" and lab["u1"].churn_event == "Downgrade"
    assert lab["u2"].churn_type == "subscription_downgrade"
    assert str(lab["u2"].churn_timestamp) == "2024-01-02 00:00:00"
    assert lab["u3"].churn_type == "inactivity"
    assert lab["u4"].churn_type == "not_churned" and not lab["u4"].is_churned
    assert "" in lab


def test_inactivity_threshold_is_inclusive_floor(spark):
    rows = [dict(event_id=1, userId="a", ts="2024-01-01 00:00:00"),
            dict(event_id=2, userId="b", ts="2024-01-01 00:00:01"),
            dict(event_id=3, userId="end", ts="2024-01-31 00:00:00")]
    lab = _lab(make_events(spark, rows))
    assert lab["a"].churn_type == "inactivity"          # exactly 30 days
    assert lab["b"].churn_type == "not_churned"         # 29.99 days floors to 29


def test_tie_break_by_event_id(spark):
    rows = [dict(event_id=2, userId="u", ts="2024-01-01 00:00:00", page="Submit Downgrade"),
            dict(event_id=1, userId="u", ts="2024-01-01 00:00:00", page="Downgrade")]
    assert _lab(make_events(spark, rows))["u"].churn_event == "Downgrade"


def test_two_formulations_agree_and_partition_users(spark):
    from ebbline.sources.adapters import load_activity_events
    ev = load_activity_events(spark, "/root/testdata/sf0.001")
    a = L.churn_labels(ev, 1)
    b = L.churn_labels_setwise(ev, 1)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == ev.select("userId").distinct().count()
    assert a.filter(F.col("is_churned") != (F.col("churn_type") != "not_churned")).count() == 0


def test_subscription_is_subset_of_inactivity(spark):
    from ebbline.sources.adapters import load_order_events
    ev = load_order_events(spark, "/root/testdata/sf0.001")
    s = L.subscription_churn(ev, 365).select("userId")
    i = L.inactivity_churn(ev, 365).select("userId")
    assert s.subtract(i).count() == 0


def test_post_cutoff_explicit_label_option(spark):
    rows = [dict(event_id=1, userId="u", ts="2024-01-01 00:00:00", page="Submit Downgrade"),
            dict(event_id=2, userId="u", ts="2024-01-20 00:00:00"),
            dict(event_id=3, userId="v", ts="2024-01-15 00:00:00", page="Downgrade"),
            dict(event_id=4, userId="v", ts="2024-01-20 00:00:00")]
    df = make_events(spark, rows)
    lab = {r.userId: r.churn_type for r in L.churn_labels(df, 30, explicit_after="2024-01-10").collect()}
    assert lab == {"u": "not_churned", "v": "explicit"}
