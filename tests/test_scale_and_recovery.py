"""What has to hold at any size and after a failure: global order, late rows, stable ids, model and log fallback."""
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_events
from ebbline.operators import cumulative as C
from ebbline.operators import dataset as DS
from ebbline.operators import drift as D
from ebbline.operators import evaluate as V
from ebbline.operators import features as X
from ebbline.session import clear_staged, ensure_checkpoint_dir, staged
from ebbline.sources import eventlog as EL
from ebbline.sources import registry as REG
from ebbline.streaming import streams as ST


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.unset("spark.sql.exchange.reuse")


def test_global_index_with_payload(spark, reuse):
    df = spark.range(100_000).select(F.col("id").cast("string").alias("userId"), (F.hash("id") % 1000).alias("days_since_registration"),
                                     F.rand(3).alias("a"), F.lit("text").alias("b"))
    out = DS.expanding_folds(df).toPandas()
    assert sorted(out.idx) == list(range(100_000))
    order = out.sort_values("idx")
    assert (order.days_since_registration.to_numpy()[:-1] >= order.days_since_registration.to_numpy()[1:]).all()
    assert out.groupby("test_fold").size().tolist() == [25_000] * 3


def test_prefix_sums_with_payload(spark, reuse):
    df = spark.range(50_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"), F.rand(1).alias("p"),
                                    (F.col("id") % 2).alias("g"))
    out = C.prefix_sums(df, "k", ["v"], group="g").toPandas().sort_values(["g", "k"])
    assert (out.groupby("g").v.cumsum() == out.cum_v).all()


def test_curves_and_quantiles_on_many_values(spark, reuse):
    n = 200_000
    df = staged(spark.range(n).select(F.rand(5).alias("score"), F.rand(6).alias("u"))
                .withColumn("label", (F.col("u") < F.col("score")).cast("int")))
    p = df.toPandas()
    order = p.sort_values("score", ascending=False)
    tp, fp = order.label.cumsum(), (1 - order.label).cumsum()
    auc = np.trapezoid(np.r_[0, tp / tp.iloc[-1]], np.r_[0, fp / fp.iloc[-1]])
    assert abs(V.roc_auc(df).first()["roc_auc"] - auc) < 1e-9
    assert abs(C.exact_quantile(df, "score", 0.7).first()["q"] - np.quantile(p.score, 0.7)) < 1e-12
    long = df.select(F.lit("f").alias("feature"), F.col("score").alias("value"),
                     F.when(F.col("label") == 1, D.REF if hasattr(D, "REF") else "reference").otherwise(D.CUR).alias("side"))
    a, b = np.sort(p.score[p.label == 1]), np.sort(p.score[p.label == 0])
    x = np.concatenate([a, b])
    ks = np.abs(np.searchsorted(a, x, "right") / len(a) - np.searchsorted(b, x, "right") / len(b)).max()
    assert any(isinstance(v, float) and abs(v - ks) < 1e-9 for v in D.ks_numeric(long).first())


@pytest.mark.parametrize("q", [0.0, 0.25, 0.7, 0.999, 1.0])
def test_timestamp_quantile(spark, q):
    us = [1_700_000_000_000_000 + (i * i * 7_919) % 90_000_000_000 for i in range(3000)] + [1_700_000_000_000_000] * 900
    df = spark.createDataFrame([(v,) for v in us] + [(None,)], "us long").select(F.timestamp_micros("us").alias("ts"))
    assert abs(C.exact_timestamp_quantile(df, "ts", q) - np.quantile(np.array(us, float), q)) < 1
    assert C.exact_timestamp_quantile(df.limit(0), "ts", q) is None


def test_late_rows_survive(spark):
    base = tempfile.mkdtemp(prefix="ebb-late-")

    def put(first, day):
        ev = make_events(spark, [dict(event_id=first + i, userId="u", ts=f"2024-01-{day} 00:00:00") for i in range(100)])
        ev.withColumn("event_date", F.to_date("ts")).write.mode("append").partitionBy("event_date").parquet(f"{base}/src")
        ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
        ST.rate_stream(spark, f"{base}/src", f"{base}/rates", f"{base}/ckpt2")
        return spark.read.parquet(f"{base}/out").count()

    assert put(0, 20) == 100
    assert put(1000, 10) == 200           # ten days late
    assert put(1000, 10) == 200           # the same events again
    rates = {str(r["day_start"])[:10]: r["events"] for r in ST.read_rates(spark, f"{base}/rates").collect()}
    assert rates == {"2024-01-10": 200, "2024-01-20": 100}


def test_event_ids_are_stable(spark):
    base = tempfile.mkdtemp(prefix="ebb-ids-")
    lines = ['{"userId":"%d","ts":1538352117000}' % (i % 50) for i in range(500)]
    for name in ("a", "b"):
        os.makedirs(f"{base}/{name}")
        with open(f"{base}/{name}/log.json", "w") as f:
            f.write("\n".join(lines))
    ids = [sorted(r[0] for r in EL.scan_event_log(spark, f"{base}/{n}").select("event_id").collect()) for n in "aab"]
    assert ids[0] == ids[1] and len(set(ids[0])) == 500 and not set(ids[0]) & set(ids[2])


def test_hot_user_is_spread(spark):
    """A third of all rows under a blank id, each in its own session: no exchange of the fine table by user alone."""
    rows = [dict(event_id=i, userId="" if i % 3 == 0 else f"u{i % 40}", ts=f"2024-01-{1 + i % 20:02d} 00:00:00",
                 sessionId=f"s{i}") for i in range(3000)]
    fm = X.feature_matrix(make_events(spark, rows), None, features=["unique_sessions", "total_events"])
    assert fm.columns == ["userId", "unique_sessions", "total_events", "location_state"]
    got = {r["userId"]: r["unique_sessions"] for r in fm.collect()}
    assert got[""] == 1000
    plan = fm._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_model_fallback_and_corrupt_log(spark):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.linalg import Vectors
    import datetime as dt
    import shutil
    base = tempfile.mkdtemp(prefix="ebb-fall-")
    train = spark.createDataFrame([(0.0, Vectors.dense([0.0])), (1.0, Vectors.dense([1.0]))], ["label", "features"])
    m = LogisticRegression(maxIter=5).fit(train)
    paths = [REG.save_model(m, f"{base}/reg", f"{base}/models", {"pr_auc": 0.5}, "lr", ["x"], None, deploy,
                            dt.datetime(2024, 1, day)) for day, deploy in ((1, False), (2, True), (3, True))]
    shutil.move(paths[2], f"{base}/gone")
    assert REG.load_latest_model(spark, f"{base}/reg", LogisticRegressionModel.load)[1]["model_path"] == paths[1]
    shutil.move(paths[1], f"{base}/gone2")
    assert REG.load_latest_model(spark, f"{base}/reg", LogisticRegressionModel.load)[1]["model_path"] == paths[0]
    shutil.move(paths[0], f"{base}/gone3")
    assert REG.load_latest_model(spark, f"{base}/reg", LogisticRegressionModel.load) == (None, None)
    os.makedirs(f"{base}/perf")
    with open(f"{base}/perf/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    assert REG.read_perf_log(spark, f"{base}/perf").count() == 0


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = staged(spark.range(5).withColumn("none", F.lit(None)))
    assert df.count() == 5
    path = df.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert path.startswith(ensure_checkpoint_dir(spark).removeprefix("file:").replace("///", "/")) and os.path.exists(path)
    clear_staged(spark)
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace
    from ebbline import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake)
