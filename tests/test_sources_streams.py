import os
import tempfile

from pyspark.sql import functions as F

from conftest import make_events
from ebbline.operators.prep import preprocess_events
from ebbline.operators.sessions import gap_session_seq
from ebbline.sources import eventlog as EL
from ebbline.sources import registry as REG


def test_json_lines_scan_keeps_mistyped_drops_malformed(spark):
    d = tempfile.mkdtemp(prefix="ebb-json-")
    lines = [
        '{"userId":"7","ts":1538352117000,"registration":1537000000000,"sessionId":29,"page":"NextSong",'
        '"level":"paid","auth":"Logged In","method":"PUT","gender":"F","location":"Tampa, FL","artist":"A",'
        '"song":"S","length":241.3}',
        '{"userId":"7","ts":1538352118000,',                       # malformed
        '',                                                         # blank
        '{"userId":8,"ts":1538352119000,"length":"long","page":null}',   # mistyped length, kept
        '{"userId":"9","ts":1538352120000,"page":"Home"}',           # no registration
        '12',                                                       # a scalar, not an object
    ]
    with open(os.path.join(d, "log.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    ev = preprocess_events(EL.scan_event_log(spark, d))
    rows = {r.userId: r for r in ev.collect()}
    assert sorted(rows) == ["7", "8", "9"]
    assert rows["8"].length is None and rows["8"].page == "Unknown"
    assert rows["9"].registration is None
    assert str(rows["7"].ts) == "2018-10-01 00:01:57"


def test_gap_sessions_across_chunks_match_brute_force(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    offs = [0, 5, 400, 401, 800, 1300, 1301, 1302, 3000]      # minutes
    rows = [(i, 1, base + dt.timedelta(minutes=m)) for i, m in enumerate(offs)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    got = [r.session_seq for r in gap_session_seq(df, "user_id", gap_seconds=6 * 3600, chunk_seconds=3600)
           .orderBy("event_id").collect()]
    expect, seq, prev = [], 0, None
    for m in offs:
        if prev is None or m - prev > 360:
            seq += 1
        expect.append(seq)
        prev = m
    assert got == expect


def test_registry_and_logs(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.classification import LogisticRegressionModel
    base = tempfile.mkdtemp(prefix="ebb-reg-")
    train = spark.createDataFrame([(0.0, Vectors.dense([0.0])), (1.0, Vectors.dense([1.0]))], ["label", "features"])
    m = LogisticRegression(maxIter=5).fit(train)
    p = REG.save_model(m, f"{base}/registry", f"{base}/models", {"pr_auc": 0.9}, "logistic_regression", ["x"],
                       None, True)
    loaded, row = REG.load_latest_model(spark, f"{base}/registry", LogisticRegressionModel.load)
    assert row["model_path"] == p and loaded is not None
    assert REG.scan_registry(spark, f"{base}/registry").first().pr_auc == 0.9
    assert REG.read_perf_log(spark, f"{base}/missing").count() == 0
    entry = spark.createDataFrame([(None, "x", True, 0.5, False, 0.2)], REG.MONITOR_LOG_SCHEMA) \
        .withColumn("timestamp", F.current_timestamp())
    for _ in range(3):
        REG.sink_monitor_log(entry, f"{base}/mon")
    assert REG.read_monitor_log(spark, f"{base}/mon", keep=2).count() == 2


def test_incremental_stream_is_idempotent(spark):
    from ebbline.sources.canonical import write_events
    from ebbline.streaming import streams as ST
    base = tempfile.mkdtemp(prefix="ebb-stream-")
    ev = make_events(spark, [dict(event_id=i, userId="u", ts=f"2024-01-0{1 + i % 5} 00:00:00") for i in range(10)])
    write_events(ev, f"{base}/src", num_partitions=2)
    ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")   # nothing new: no duplicates
    assert spark.read.parquet(f"{base}/out").count() == 10
