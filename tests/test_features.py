from pyspark.sql import functions as F

from conftest import make_events
from ebbline import schema as S
from ebbline.operators import features as X

CUT = "2024-01-10 00:00:00"


def _fm(df, cutoff=CUT):
    return {r.userId: r for r in X.feature_matrix(df, cutoff, materialize=False).collect()}


def test_user_without_history_is_all_zero(spark):
    rows = [dict(event_id=1, userId="late", ts="2024-01-20 00:00:00", page="Downgrade"),
            dict(event_id=2, userId="early", ts="2024-01-05 00:00:00")]
    fm = _fm(make_events(spark, rows))
    late = fm["late"]
    assert all(getattr(late, c) == 0.0 for c in S.NUMERIC_FEATURES)      # even days_since_downgrade
    assert late.location_state is None
    assert fm["early"].days_since_downgrade == 999.0


def test_exactly_seven_active_days_uses_all_as_history(spark):
    rows = [dict(event_id=i, userId="u", ts=f"2024-01-0{i} 12:00:00") for i in range(1, 8)]
    rows.append(dict(event_id=99, userId="u", ts="2024-01-07 13:00:00"))
    u = _fm(make_events(spark, rows))["u"]
    assert u.activity_trend_events == 1.0          # recent == history == all 7 days


def test_one_session_std_zero_and_null_registration(spark):
    rows = [dict(event_id=1, userId="u", ts="2024-01-05 00:00:00", sessionId="x", registration=None),
            dict(event_id=2, userId="u", ts="2024-01-05 00:30:00", sessionId="x", registration=None)]
    u = _fm(make_events(spark, rows))["u"]
    assert u.session_duration_std == 0.0 and u.max_session_duration == 30.0
    assert u.days_since_registration == 0.0


def test_levels_paid_free_paid(spark):
    rows = [dict(event_id=1, userId="u", ts="2024-01-01 00:00:00", level="paid"),
            dict(event_id=2, userId="u", ts="2024-01-02 00:00:00", level="free"),
            dict(event_id=3, userId="u", ts="2024-01-03 00:00:00", level="paid")]
    u = _fm(make_events(spark, rows))["u"]
    assert (u.subscription_changes, u.downgraded_to_free, u.upgraded_to_paid) == (1.0, 1.0, 0.0)
    assert (u.current_level_paid, u.days_as_paid, u.events_as_paid) == (1.0, 2.0, 2.0)


def test_no_leakage_after_cutoff_and_order_independence(spark):
    from ebbline.sources.adapters import load_activity_events
    ev = load_activity_events(spark, "/root/testdata/sf0.001")
    cut = "2024-01-21 00:00:00"
    a = X.feature_matrix(ev, cut, materialize=False)
    extra = ev.filter(F.col("ts") > F.lit(cut).cast("timestamp")).withColumn("page", F.lit("Downgrade")) \
        .withColumn("event_id", F.col("event_id") + 10_000_000)
    b = X.feature_matrix(ev.unionByName(extra).orderBy(F.rand(7)), cut, materialize=False)
    assert a.exceptAll(b).count() == 0


def test_contract_order_and_types(spark):
    rows = [dict(event_id=1, userId="u", ts="2024-01-05 00:00:00")]
    df = X.feature_matrix(make_events(spark, rows), CUT, materialize=False)
    assert df.columns == ["userId"] + S.NUMERIC_FEATURES + ["location_state"]
    assert all(f.dataType.simpleString() == "double" for f in df.schema.fields[1:-1])
