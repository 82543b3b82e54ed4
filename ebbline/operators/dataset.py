"""Training-set preparation (M1-M4, W7) as DataFrame plans.

The only values brought to the driver are bounded by construction: the
split quantile (one number), at most ten state names, and the per-feature
mean/std table (one row per feature) - never rows of the data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import staged
from .cumulative import exact_quantiles, global_row_index
from .scalars import attach_scalars


# M1 ----------------------------------------------------------------------------
def time_based_split(df: DataFrame, test_size: float = 0.2, col: str = "days_since_registration") -> DataFrame:
    """Add ``split``: 'train' if ``col <= q`` else 'test', q = exact (linear)
    quantile 1 - test_size.  Test users are the longest registered.  The rows
    are written once: the quantile and the split read the same ones."""
    df = staged(df)
    q = exact_quantiles(df, {"q": (col, 1.0 - test_size)})["q"]
    return df.withColumn("split", F.when(F.col(col) <= F.lit(q).cast("double"), "train").otherwise("test"))


# M2 ----------------------------------------------------------------------------
def top_states(df: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` location_state values by count (ties: name)."""
    c = df.filter(F.col("location_state").isNotNull()).groupBy("location_state").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.col("n").desc(), F.col("location_state")).limit(k)


def common_states(train: DataFrame, test: DataFrame, k: int = 10) -> DataFrame:
    """States in the top ``k`` of BOTH sides (each side chooses separately,
    only common flags survive).  Columns: location_state, train_count, test_count."""
    a = top_states(train, k).withColumnRenamed("n", "train_count")
    b = top_states(test, k).withColumnRenamed("n", "test_count")
    return a.join(b, "location_state")


def state_one_hot(df: DataFrame, states: list[str]) -> DataFrame:
    """``state_<X>`` 0/1 flags for a (small, driver-side) list of states."""
    return df.select("*", *[(F.col("location_state") == s).cast("int").alias(f"state_{s}") for s in states])


def state_list(train: DataFrame, test: DataFrame, k: int = 10) -> list[str]:
    """The common state names, sorted (at most ``k`` values reach the driver)."""
    return sorted(r["location_state"] for r in common_states(train, test, k).collect())


# M3 ----------------------------------------------------------------------------
def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """weight_c = n / (n_classes * n_c); the per-class counts are a tiny table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = attach_scalars(counts, tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)   # one row per class


# M4 ----------------------------------------------------------------------------
def scaler_params(train: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean, std) fitted on train: population std, 0 -> 1."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(features)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(features)])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{i}").alias("mean"),
                                                   F.col(f"s_{i}").alias("std"))
                                          for i, c in enumerate(features)])).alias("p")).select("p.*")
    return long.withColumn("std", F.when(F.col("std").isNull() | (F.col("std") == 0), F.lit(1.0))
                           .otherwise(F.col("std")))


def standard_scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """Apply (x - mean) / std with driver-side parameters (one pair per feature)."""
    return df.select(*[((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(params[c][0]))
                        / F.lit(params[c][1])).alias(c) if c in params else F.col(c) for c in df.columns])


def collect_scaler(params: DataFrame) -> dict[str, tuple[float, float]]:
    return {r["feature"]: (float(r["mean"]), float(r["std"])) for r in params.collect()}


# W7 ----------------------------------------------------------------------------
def expanding_folds(df: DataFrame, n_splits: int = 3, order=None) -> DataFrame:
    """Forward folds by row position: test_size = n // (n_splits + 1); fold i
    tests rows [start_i, start_i + test_size) and trains on all rows before.

    Row order: days_since_registration descending, then userId (the
    reference orders by feature-row position; a time order is documented).
    Adds ``idx`` and ``test_fold`` (null for rows only ever in training).
    """
    order = order or [F.col("days_since_registration").desc(), F.col("userId").asc()]
    idx = global_row_index(df, order)
    n = df.agg(F.count(F.lit(1))).scalar()
    ts = F.floor(n / (n_splits + 1))
    start0 = n - n_splits * ts
    fold = F.when((F.col("idx") >= start0) & (ts > 0), F.floor((F.col("idx") - start0) / ts).cast("int"))
    return idx.withColumn("test_fold", fold).withColumn("test_size", ts.cast("long")) \
        .withColumn("fold_start0", start0.cast("long"))


# F6 + M2: model input columns ---------------------------------------------------------
def model_columns(df: DataFrame, states: list[str]) -> list[str]:
    base = [c for c in S.NUMERIC_FEATURES if c in df.columns]
    return base + [f"state_{s}" for s in states]
