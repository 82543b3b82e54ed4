"""Line numbering without an exchange of lines, sink reads by date, mergeable day rows, sketch-guided running sums, quantiles."""
import datetime as dt
import math
import os
import random
import re
import tempfile

import numpy as np
import pytest
from conftest import make_events
from pyspark.sql import functions as F

from ebbline.operators import cumulative as C
from ebbline.operators import drift as D
from ebbline.operators.bits import bit_table, maybe_in
from ebbline.sources import eventlog as EL
from ebbline.sources.canonical import write_events
from ebbline.streaming import streams as ST


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- S1 -----------------------------------------------------------------------------------------------------------

def log_folder(files):
    d = tempfile.mkdtemp(prefix="ebb-log-")
    for name, lines in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    return d


def line(i, page="Home"):
    return f'{{"userId":"{i}","ts":{1538352117000 + i},"page":"{page}"}}'


def test_scan_numbers_repeated_lines_only(spark):
    d = log_folder({"a.json": [line(i) for i in range(500)] + [line(1)] * 3 + [line(2)], "b.json": [line(1), line(7), "broken", ""]})
    got = EL.scan_event_log(spark, d).select("userId", "event_id").collect()
    assert len(got) == 506 and len({r.event_id for r in got}) == 506
    again = EL.scan_event_log(spark, d).select("userId", "event_id").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    # the ids are those of the file, the line and its number
    want = [(f, v, i) for f, rows in (("a.json", [(line(k), 4 if k == 1 else 2 if k == 2 else 1) for k in range(500)]),
                                      ("b.json", [(line(1), 1), (line(7), 1)])) for v, n in rows for i in range(n)]
    ids = spark.createDataFrame([(f"file:{d}/{f}", v, i) for f, v, i in want], "file string, value string, i long").select(
        F.xxhash64("file", "value", "i").alias("id"))
    assert {r.id for r in ids.collect()} == {r.event_id for r in got}


def test_scan_exchanges_no_line_where_none_is_repeated(spark):
    d = log_folder({"a.json": [line(i) for i in range(200)]})
    plan = physical(EL.scan_event_log(spark, d))
    assert "Exchange" not in plan
    d = log_folder({"a.json": [line(i) for i in range(200)] + [line(3)]})
    plan = physical(EL.scan_event_log(spark, d))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1      # of the lines that the bit table lets through


def test_scan_numbers_right_whatever_the_table_lets_through(spark, monkeypatch):
    d = log_folder({"a.json": [line(i % 40) for i in range(100)] + [line(50)] * 25})
    want = sorted(r.event_id for r in EL.scan_event_log(spark, d).collect())
    from ebbline.operators import bits
    monkeypatch.setattr(EL, "bit_table", lambda t, c: bits.bit_table(t, c, 1))
    monkeypatch.setattr(EL, "maybe_in", lambda *a: bits.maybe_in(*a, words=1))
    assert sorted(r.event_id for r in EL.scan_event_log(spark, d).collect()) == want and len(set(want)) == 125


def test_bit_table_has_no_false_negatives(spark):
    some = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("h"))
    table = bit_table(some, "h", 64)
    assert table.count() <= 64
    got = maybe_in(spark.range(3000).select("id", F.xxhash64("id").alias("h")), table, "h", "maybe", 64)
    assert got.filter("id % 3 = 0 AND NOT maybe").count() == 0
    wide = maybe_in(spark.range(3000).select("id", F.xxhash64("id").alias("h")), bit_table(some, "h"), "h", "maybe")
    assert wide.filter("id % 3 != 0 AND maybe").count() < 30


# -- T1 -----------------------------------------------------------------------------------------------------------

def test_a_batch_reads_its_own_dates_of_the_sink_only(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="ebb-t1-")
    run = lambda: ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    first = [dict(event_id=i, userId="u", ts=f"2024-01-{1 + i % 20:02d} 01:00:00") for i in range(100)]
    second = [dict(event_id=i, userId="u", ts=f"2024-01-{d:02d} 01:00:00") for i, d in ((0, 1), (500, 1), (19, 20), (501, 20))]
    read = []
    keep = ST.earlier_ids

    def spy(*args):
        out = keep(*args)
        read.append([] if out is None else sorted(set(re.findall(r"event_date=([\d-]+)", " ".join(out.inputFiles())))))
        return out

    monkeypatch.setattr(ST, "earlier_ids", spy)
    write_events(make_events(spark, first), f"{base}/src", num_partitions=2)
    run()
    ev = make_events(spark, second).withColumn("event_date", F.to_date("ts"))
    ev.write.mode("append").partitionBy("event_date").parquet(f"{base}/src")
    run()
    assert read == [[], ["2024-01-01", "2024-01-20"]]        # not the eighteen dates between
    assert spark.read.parquet(f"{base}/out").count() == 102


def test_many_late_events_are_joined_with_the_sink(spark, monkeypatch):
    monkeypatch.setattr(ST, "FEW_IDS", 3)
    base = tempfile.mkdtemp(prefix="ebb-t1-")
    for k in range(3):
        ev = make_events(spark, [dict(event_id=i, userId="u", ts=f"2024-01-0{1 + i % 4} 01:00:00") for i in range(k * 10, 40 + k * 10)])
        ev.withColumn("event_date", F.to_date("ts")).write.mode("append").partitionBy("event_date").parquet(f"{base}/src")
        ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    assert sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect()) == list(range(60))


def test_a_batch_written_again_replaces_its_rows(spark):
    base = tempfile.mkdtemp(prefix="ebb-t1-")
    ev = make_events(spark, [dict(event_id=i, userId="u", ts="2024-01-01 01:00:00") for i in range(5)])
    ev.withColumn("event_date", F.to_date("ts")).write.partitionBy("event_date").parquet(f"{base}/src")
    ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    ST.incremental_stream(spark, f"{base}/src", f"{base}/out", f"{base}/other")    # batch 0 a second time, as after a failure
    assert spark.read.parquet(f"{base}/out").count() == 5


# -- T2, D12 ------------------------------------------------------------------------------------------------------

def test_event_rate_from_day_rows(spark):
    rng = random.Random(1)
    base = tempfile.mkdtemp(prefix="ebb-t2-")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(10)]
    rows = [dict(event_id=i, userId=f"u{rng.randrange(3000 if i % 3 else 40)}", ts=f"{rng.choice(days)} {rng.randrange(24):02d}:00:00")
            for i in range(6000)]
    ev = make_events(spark, rows)
    # the older days come late, in a second run: sketches of a day go on growing
    for late in (False, True):
        (ev.filter((F.dayofmonth("ts") <= 3) == F.lit(late)).unionByName(ev.filter("event_id < 200") if late else ev.limit(0))
           .withColumn("event_date", F.to_date("ts")).write.mode("append").partitionBy("event_date").parquet(f"{base}/src"))
        ST.rate_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    rates = ST.read_rates(spark, f"{base}/out")
    got = D.event_rate_proxy_from_rates(rates, dt.date(2024, 1, 6)).first()
    side = F.when(F.to_date("ts") < F.lit(dt.date(2024, 1, 6)), "reference").otherwise("current").alias("side")
    want = D.event_rate_proxy(ev.unionByName(ev.filter("event_id < 200")).select("*", side)).first()
    for c in ("reference_event_rate", "current_event_rate"):
        assert got[c] == pytest.approx(want[c], rel=0.03)
    assert got["performance_degradation"] == want["performance_degradation"]
    assert "users" in rates.columns and len(rates.collect()) == 10
    one_side = D.event_rate_proxy_from_rates(rates, dt.date(2023, 1, 1)).first()
    assert one_side["reference_event_rate"] == 0.0 and one_side["event_rate_change"] == 0.0


# -- KS -----------------------------------------------------------------------------------------------------------

def skewed_counts(spark):
    rng = np.random.default_rng(3)
    big = {float(v): (int(r), int(c)) for v, r, c in zip(rng.lognormal(0, 4, 20000), rng.integers(0, 5, 20000), rng.integers(0, 5, 20000))}
    rows = [("big", v, r, c) for v, (r, c) in big.items()]
    rows += [(f"small{k}", float(v), int(v % 3), int(v % 2)) for k in range(5) for v in range(7)]
    rows += [("odd", v, 1, 2) for v in (float("-inf"), -1.0, 0.0, float("inf"), float("nan"))] + [("one", 5.0, 3, 0)]
    return spark.createDataFrame(rows, "feature string, value double, r long, c long")


@pytest.mark.parametrize("parts", [1, 2, 16])
def test_running_sums_in_sketched_parts(spark, parts):
    counts = skewed_counts(spark)
    got = C.prefix_sums_by_sketch(counts, "value", ["r", "c"], "feature", parts).collect()
    key = lambda v: (math.isnan(v), 0 if math.isnan(v) else v)
    for name in {r.feature for r in got}:
        mine = sorted((r for r in got if r.feature == name), key=lambda r: key(r.value))
        assert [r.cum_r for r in mine] == np.cumsum([r.r for r in mine]).tolist()
        assert [r.cum_c for r in mine] == np.cumsum([r.c for r in mine]).tolist()
    assert len(got) == counts.count()


def test_parts_are_even_for_one_feature_with_nearly_all_rows(spark):
    counts = skewed_counts(spark)
    marks = {r.feature: r.marks for r in C.sketch_marks(counts, "value", "feature", 16).collect()}
    values = [r.value for r in counts.filter("feature = 'big'").collect()]
    sizes = np.bincount(np.searchsorted(np.array(marks["big"]), values), minlength=16)
    assert sizes.max() < 1.5 * len(values) / 16 and sizes.min() > 0.5 * len(values) / 16


def test_ks_matches_plain_on_skewed_features(spark):
    rng = np.random.default_rng(5)
    a, b = rng.lognormal(0, 3, 3000), rng.lognormal(0.3, 3, 2000)
    rows = [("reference", "x", float(v)) for v in a] + [("current", "x", float(v)) for v in b]
    rows += [(s, "const", 1.0) for s in ("reference", "current")] + [("reference", "alone", 2.0)]
    got = {r.feature: r.ks_statistic for r in D.ks_numeric(spark.createDataFrame(rows, "side string, feature string, value double")).collect()}
    grid = np.sort(np.r_[a, b])
    want = np.max(np.abs(np.searchsorted(np.sort(a), grid, side="right") / 3000 - np.searchsorted(np.sort(b), grid, side="right") / 2000))
    assert got["x"] == pytest.approx(want, abs=1e-12) and got["const"] == 0.0 and got["alone"] is None


# -- quantiles ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("few,bins", [(100_000, 4096), (30, 64)])
def test_quantiles_of_several_columns_at_once(spark, few, bins):
    rng = np.random.default_rng(9)
    cols = {"a": rng.normal(size=400), "b": rng.lognormal(0, 20, 400), "c": rng.integers(0, 3, 400).astype(float),
            "d": np.full(400, 7.0), "e": np.r_[np.full(399, -1e308), 1e308], "f": np.r_[[np.inf, -np.inf], rng.normal(size=398)]}
    rows = [tuple(float(cols[k][i]) for k in cols) + (None,) for i in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} double" for k in [*cols, "z"]))
    wanted = {f"{k}{q}": (k, q) for k in cols for q in (0.0, 0.31, 0.5, 0.995, 1.0)} | {"none": ("z", 0.5)}
    got = C.exact_quantiles(df, wanted, bins, few)
    assert got.pop("none") is None
    for name, (k, q) in wanted.items():
        if name != "none":
            s = np.sort(cols[k])
            pos = (len(s) - 1) * q
            lo, hi = s[math.floor(pos)], s[math.ceil(pos)]
            want = lo if lo == hi or pos == math.floor(pos) else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi
            assert got[name] == want or got[name] == pytest.approx(want, rel=1e-12), name


def test_quantile_with_nan_and_without_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,), (float("nan"),)], "x double")
    for few, bins in ((10, 8), (1, 16)):
        got = C.exact_quantiles(df, {"lo": ("x", 0.0), "third": ("x", 1 / 3), "hi": ("x", 1.0)}, bins, few)
        assert got["lo"] == 1.0 and got["third"] == 2.0 and math.isnan(got["hi"])
    assert C.exact_quantiles(df.limit(0), {"q": ("x", 0.5)}) == {"q": None}


# -- K2, K3 -------------------------------------------------------------------------------------------------------

def plain_top(values, k):
    from collections import Counter
    return sorted(((n, v) for v, n in Counter(values).items()), key=lambda x: (-x[0], x[1]))[:k]


def test_top_values_by_sketch_equal_the_full_count(spark, monkeypatch):
    from ebbline.operators import explore as E
    rng = random.Random(4)
    values = [f"v{rng.randrange(8) if rng.random() < 0.5 else rng.randrange(3000)}" for _ in range(20000)]
    df = spark.createDataFrame([(v, "x") for v in values] + [(None, "x")] * 9000, "page string, artist string").repartition(6)
    assert len(set(values)) > 1500
    counts = E.heavy_counts(df, ["page"], 5, 750)                 # a sketch of far fewer values than there are
    assert counts is not None and counts.count() < 751
    for k, tracked in ((5, 750), (5, 10_000), (400, 750)):        # proven, whole, and not provable
        got = [(r["count"], r["page"]) for r in E.top_k(df, ["page"], k, tracked=tracked, sketch_from=0).orderBy("rank").collect()]
        assert got == plain_top(values, k)
    assert E.heavy_counts(df, ["page"], 400, 750) is None
    two = E.top_k(df, ["page", "artist"], 3, sketch_from=0).orderBy("rank").collect()
    assert [(r["count"], r["page"]) for r in two] == plain_top(values, 3)
    assert E.top_k(df.limit(0), ["page"], 3, sketch_from=0).collect() == []
    assert [(r["count"], r["page"]) for r in E.top_k(df, ["page"], 9).orderBy("rank").collect()] == plain_top(values, 9)


# -- T3 -----------------------------------------------------------------------------------------------------------

def test_a_model_deployed_between_two_batches_is_used_and_replay_keeps_it(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from ebbline.sources import registry as REG
    base = tempfile.mkdtemp(prefix="ebb-t3-")
    schema = "userId string, total_events double, label double"
    rows = spark.createDataFrame([(f"u{i}", float(i), float(i > 5)) for i in range(12)], schema)
    va = VectorAssembler(inputCols=["total_events"], outputCol="features")

    def deploy(day, **kw):
        fitted = Pipeline(stages=[va, LogisticRegression(**kw)]).fit(rows)
        return REG.save_model(fitted, f"{base}/registry", f"{base}/models", {}, "lr", ["total_events"], None, True, dt.datetime(2024, 1, day))

    def run(ckpt):
        ST.score_stream(spark, f"{base}/src", rows.schema, f"{base}/out", f"{base}/{ckpt}", registry=f"{base}/registry")
        return sorted((r.userId, r.batch_id, r.model_path, round(r.churn_probability, 9)) for r in spark.read.parquet(f"{base}/out/scores").collect())

    with pytest.raises(Exception, match="no usable model"):
        rows.limit(1).coalesce(1).write.mode("overwrite").parquet(f"{base}/src")
        run("none")
    first = deploy(1, maxIter=5)
    run("ckpt")
    second = deploy(2, maxIter=5, regParam=0.5)
    rows.filter("userId > 'u1'").coalesce(1).write.mode("append").parquet(f"{base}/src")
    got = run("ckpt")
    assert {(b, m) for _, b, m, _ in got} == {(0, first), (1, second)} and len(got) == 1 + rows.filter("userId > 'u1'").count()
    assert run("ckpt") == got
    deploy(3, maxIter=1, regParam=5.0)
    assert run("replayed") == got                                 # batches 0 and 1 again, by the versions they had
