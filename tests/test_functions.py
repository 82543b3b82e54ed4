import numpy as np
from pyspark.sql import functions as F

from conftest import ts
from ebbline.functions import (bin_range, days_between_floor, equal_width_bin, extract_state_nb, location_state,
                               risk_level)


def test_floored_days_negative_and_partial(spark):
    df = spark.createDataFrame([(ts("2024-01-02 01:00:00"), ts("2024-01-01 23:00:00")),
                                (ts("2024-01-01 23:00:00"), ts("2024-01-02 01:00:00")),
                                (ts("2024-01-03 00:00:00"), ts("2024-01-01 00:00:00"))], "a timestamp, b timestamp")
    got = [r[0] for r in df.select(days_between_floor("a", "b")).collect()]
    assert got == [0, -1, 2]   # datediff would say 1 for the first pair


def test_equal_width_bins_match_numpy(spark):
    rng = np.random.default_rng(3)
    ref = np.concatenate([rng.normal(10, 3, 500), [10.0 / 3, 0.1 + 0.2]])
    cur = np.concatenate([rng.normal(11, 3, 300), [ref.max(), ref.min(), ref.max() + 1]])
    edges = np.histogram(ref, bins=10)[1]
    expect = np.histogram(cur, bins=edges)[0]
    df = spark.createDataFrame([(float(v),) for v in cur], "v double")
    lo, hi = float(ref.min()), float(ref.max())
    b = df.select(equal_width_bin("v", F.lit(lo), F.lit(hi), 10).alias("b")).filter("b is not null")
    counts = dict(b.groupBy("b").count().collect())
    assert [counts.get(i, 0) for i in range(10)] == expect.tolist()


def test_bin_range_constant_widens(spark):
    df = spark.createDataFrame([(5.0, 5.0)], "a double, b double")
    lo, hi = bin_range(F.col("a"), F.col("b"))
    r = df.select(lo.alias("lo"), hi.alias("hi"), equal_width_bin(F.lit(5.0), lo, hi, 10).alias("bin")).first()
    assert (r.lo, r.hi) == (4.5, 5.5) and r.bin == 5


def test_state_extraction_variants(spark):
    df = spark.createDataFrame([("Tampa, FL",), ("NoComma",), ("Unknown",), (None,), ("A, NY-NJ-PA",)], "loc string")
    rows = df.select(location_state("loc").alias("f"), extract_state_nb("loc").alias("nb")).collect()
    assert [r.f for r in rows] == ["FL", None, None, None, "NY-NJ-PA"]
    assert [r.nb for r in rows] == ["FL", "Unknown", "Unknown", "Unknown", "NY-NJ-PA"]


def test_risk_level(spark):
    df = spark.createDataFrame([(0.8,), (0.79,), (0.5,), (0.49,)], "p double")
    assert [r[0] for r in df.select(risk_level("p")).collect()] == ["high", "medium", "medium", "low"]


def test_distributed_exact_quantile_matches_numpy_and_percentile(spark):
    from ebbline.operators.cumulative import exact_quantile
    rng = np.random.default_rng(1)
    vals = np.r_[rng.integers(0, 50, 300), rng.normal(0, 1e6, 300)].astype(float)   # ties and spread
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    for q in (0.0, 0.3, 0.7, 1.0):
        got = exact_quantile(df, "x", q).first().q
        assert got == df.agg(F.percentile("x", F.lit(q))).first()[0]
        assert got == float(np.quantile(vals, q))
