"""Data and concept drift (D3-D12) on long-form frames.

A "long" frame has columns ``side`` ('reference' | 'current'), ``feature``
and ``value``; every feature is scored in one pass, grouped by ``feature``.
The three PSI variants of the reference are kept apart on purpose: D5 for
categories, D6 (monitoring job) and D7 (retraining job) for numeric bins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bin_range, equal_width_bin
from .. import schema as S
from ..session import staged
from .cumulative import prefix_sums_by_sketch
from .features import feature_matrix
from .prep import numeric_feature_select, reference_current_split
from .scalars import combine_rows

REF, CUR = "reference", "current"
def is_ref() -> F.Column:
    return F.col("side") == REF


def is_cur() -> F.Column:
    return F.col("side") == CUR


def sided_long(df: DataFrame, features: list[str], kind: str = "double") -> DataFrame:
    """(side, feature, value) from ONE frame that carries a ``side`` column;
    nulls dropped.  One scan serves both sides and every feature."""
    cols = [F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind) for c in features]
    st = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in features]).alias("f"), F.array(*cols).alias("v")))
    return (df.select("side", st.alias("p"))
              .select("side", F.col("p.f").alias("feature"), F.col("p.v").alias("value"))
              .filter(F.col("value").isNotNull()))


def to_long(ref: DataFrame, cur: DataFrame, features: list[str], kind: str = "double") -> DataFrame:
    """Stack two frames as sides: (side, feature, value) with nulls dropped."""
    def one(df, side):
        keep = [c for c in features if c in df.columns]
        return df.select(*keep).withColumn("side", F.lit(side))
    both = one(ref, REF).unionByName(one(cur, CUR), allowMissingColumns=True)
    return sided_long(both, features, kind)


def side_value_counts(long: DataFrame) -> DataFrame:
    """(feature, value, r, c): reference and current counts per distinct value.

    KS, the PSI bins and the side totals are all aggregates of this table,
    which is at most one row per distinct (feature, value) and is
    checkpointed so the long frame is read once."""
    return staged(long.groupBy("feature", "value").agg(F.count_if(is_ref()).alias("r"),
                                                                 F.count_if(is_cur()).alias("c")))


# D3 / W6 ------------------------------------------------------------------------
def ks_numeric(long: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Two-sample KS statistic per feature: max |F_ref(v) - F_cur(v)| over the
    pooled distinct values (empirical CDFs taken with ``<=``).  The running sums
    of all features are taken in parts of equal size, cut by a quantile sketch."""
    counts = counts if counts is not None else side_value_counts(long)
    tot = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    cum = prefix_sums_by_sketch(counts, "value", ["r", "c"], "feature")
    cum = cum.join(F.broadcast(tot), "feature")      # one row per feature
    diff = F.abs(F.try_divide(F.col("cum_r"), F.col("n_ref").cast("double"))
                 - F.try_divide(F.col("cum_c"), F.col("n_cur").cast("double")))
    return cum.groupBy("feature").agg(F.max(diff).alias("ks_statistic"), F.max("n_ref").alias("n_ref"),
                                      F.max("n_cur").alias("n_cur"))


# D4 ----------------------------------------------------------------------------
def mean_shift(long: DataFrame) -> DataFrame:
    """|mean_ref - mean_cur| / std_ref (sample std; 0 or undefined -> 1)."""
    g = long.groupBy("feature").agg(F.avg(F.when(is_ref(), F.col("value"))).alias("ref_mean"),
                                    F.avg(F.when(is_cur(), F.col("value"))).alias("new_mean"),
                                    F.stddev_samp(F.when(is_ref(), F.col("value"))).alias("ref_std"))
    sd = F.when(F.col("ref_std").isNull() | (F.col("ref_std") == 0) | F.isnan("ref_std"), F.lit(1.0)) \
        .otherwise(F.col("ref_std"))
    return g.withColumn("mean_shift", F.abs(F.col("ref_mean") - F.col("new_mean")) / sd)


# D5 / J8 / U3 ----------------------------------------------------------------------
def category_shares(long: DataFrame) -> DataFrame:
    """Shares of each category per side, aligned on the union of categories
    (full outer join); an absent category has share 0.001."""
    # one row per (feature, side, category): small, read by three branches
    c = staged(long.groupBy("feature", "side", "value").agg(F.count(F.lit(1)).alias("n")))
    tot = c.groupBy("feature", "side").agg(F.sum("n").alias("t"))
    sh = c.join(tot, ["feature", "side"]).withColumn("share", F.col("n") / F.col("t"))
    ref = sh.filter(is_ref()).select("feature", "value", F.col("share").alias("ref_share"))
    cur = sh.filter(is_cur()).select("feature", "value", F.col("share").alias("new_share"))
    j = ref.join(cur, ["feature", "value"], "full_outer")
    return j.select("feature", "value", F.coalesce("ref_share", F.lit(0.001)).alias("ref_share"),
                    F.coalesce("new_share", F.lit(0.001)).alias("new_share"))


def psi_categorical(long: DataFrame) -> DataFrame:
    s = category_shares(long)
    term = (F.col("new_share") - F.col("ref_share")) * F.ln(F.col("new_share") / F.col("ref_share"))
    return s.groupBy("feature").agg(F.abs(F.sum(term)).alias("psi"))


# J9 + G9: reference bins and aligned counts ---------------------------------------------
def binned_counts(long: DataFrame, bins: int = 10, counts: DataFrame | None = None) -> DataFrame:
    """Per feature x bin (all bins present): reference and current counts on
    equal-width bins over the reference range, plus side totals."""
    counts = counts if counts is not None else side_value_counts(long)
    rng = counts.filter(F.col("r") > 0).groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    lo, hi = bin_range(F.col("mn"), F.col("mx"))
    rng = rng.select("feature", lo.alias("lo"), hi.alias("hi"))
    tot = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    b = (counts.join(F.broadcast(rng), "feature")   # one row per feature
               .withColumn("bin", equal_width_bin("value", "lo", "hi", bins))
               .filter(F.col("bin").isNotNull())
               .groupBy("feature", "bin").agg(F.sum("r").alias("ref_count"), F.sum("c").alias("cur_count")))
    grid = rng.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(b, ["feature", "bin"], "left").join(tot, "feature")
    return g.select("feature", "bin", F.coalesce("ref_count", F.lit(0)).alias("ref_count"),
                    F.coalesce("cur_count", F.lit(0)).alias("cur_count"), "n_ref", "n_cur")


# D6 ----------------------------------------------------------------------------
def psi_monitor(long: DataFrame, bins: int = 10, counts: DataFrame | None = None) -> DataFrame:
    """Monitoring-job PSI: shares over *all* non-null values of each side
    (out-of-range current values still count in the denominator), empty
    bins -> 0.0001, signed sum."""
    b = binned_counts(long, bins, counts)
    e = F.col("ref_count") / F.col("n_ref")
    a = F.try_divide(F.col("cur_count"), F.col("n_cur").cast("double"))
    e = F.when(e == 0, F.lit(0.0001)).otherwise(e)
    a = F.when(a == 0, F.lit(0.0001)).otherwise(a)
    return b.groupBy("feature").agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


# D7 ----------------------------------------------------------------------------
def psi_retrain(long: DataFrame, bins: int = 10, eps: float = 1e-6, counts: DataFrame | None = None) -> DataFrame:
    """Retraining-job PSI: (c + eps) / (sum of in-range c + bins*eps), |sum|."""
    b = binned_counts(long, bins, counts)
    sums = b.groupBy("feature").agg(F.sum("ref_count").alias("sr"), F.sum("cur_count").alias("sc"))
    b = b.join(sums, "feature")
    r = (F.col("ref_count") + eps) / (F.col("sr") + bins * eps)
    c = (F.col("cur_count") + eps) / (F.col("sc") + bins * eps)
    return b.groupBy("feature").agg(F.abs(F.sum((c - r) * F.ln(c / r))).alias("psi"))


# D8 ----------------------------------------------------------------------------
def _is_numeric(dt) -> bool:
    return isinstance(dt, (T.NumericType, T.BooleanType))


def feature_drift(ref: DataFrame, cur: DataFrame, features: list[str], threshold: float = 0.1) -> DataFrame:
    """Per feature: drift_score, drift_detected (> threshold), method, ref/new mean.

    Numeric (bool included) -> KS; other -> categorical PSI; a column absent
    on either side -> 'missing_feature'; no values -> 'insufficient_data'.
    """
    present = [f for f in features if f in ref.columns and f in cur.columns]
    both = (ref.select(*present).withColumn("side", F.lit(REF))
            .unionByName(cur.select(*present).withColumn("side", F.lit(CUR))))
    return feature_drift_sided(both, features, threshold, present=present)


def feature_drift_sided(df: DataFrame, features: list[str], threshold: float = 0.1,
                        present: list[str] | None = None) -> DataFrame:
    """:func:`feature_drift` on one frame with a ``side`` column."""
    spark = df.sparkSession
    present = present if present is not None else [f for f in features if f in df.columns]
    num = [f for f in present if _is_numeric(df.schema[f].dataType)]
    cat = [f for f in present if f not in num]
    parts = []
    if num:
        ln = sided_long(df, num, "double")
        counts = side_value_counts(ln)
        means = counts.groupBy("feature").agg(
            F.try_divide(F.sum(F.col("value") * F.col("r")), F.sum("r").cast("double")).alias("ref_mean"),
            F.try_divide(F.sum(F.col("value") * F.col("c")), F.sum("c").cast("double")).alias("new_mean"))
        k = ks_numeric(ln, counts).join(means, "feature")
        parts.append(k.select("feature", F.col("ks_statistic").alias("drift_score"), "n_ref", "n_cur",
                              F.lit("kolmogorov_smirnov").alias("method"), "ref_mean", "new_mean"))
    if cat:
        lc = sided_long(df, cat, "string")
        p = psi_categorical(lc).join(lc.groupBy("feature").agg(F.count_if(is_ref()).alias("n_ref"),
                                                                F.count_if(is_cur()).alias("n_cur")), "feature")
        parts.append(p.select("feature", F.col("psi").alias("drift_score"), "n_ref", "n_cur",
                              F.lit("population_stability_index").alias("method"),
                              F.lit(None).cast("double").alias("ref_mean"), F.lit(None).cast("double").alias("new_mean")))
    names = spark.createDataFrame([(f, f in present) for f in features], "feature string, present boolean")
    scored = None
    for p in parts:
        scored = p if scored is None else scored.unionByName(p)
    if scored is None:
        scored = spark.createDataFrame([], "feature string, drift_score double, n_ref long, n_cur long, method string, "
                                           "ref_mean double, new_mean double")
    out = F.broadcast(names).join(scored, "feature", "left")   # one row per feature name
    enough = F.coalesce(F.col("n_ref"), F.lit(0)) > 0
    enough = enough & (F.coalesce(F.col("n_cur"), F.lit(0)) > 0)
    method = (F.when(~F.col("present"), "missing_feature").when(~enough, "insufficient_data")
              .otherwise(F.col("method")))
    ok = F.col("present") & enough
    score = F.when(ok, F.col("drift_score")).otherwise(F.lit(0.0))
    return out.select("feature", score.alias("drift_score"), (ok & (score > threshold)).alias("drift_detected"),
                      method.alias("method"), F.when(ok, F.col("ref_mean")).alias("ref_mean"),
                      F.when(ok, F.col("new_mean")).alias("new_mean"))


# D9 ----------------------------------------------------------------------------
def drift_features_of(df: DataFrame) -> list[str]:
    """Numeric (not bool) columns except is_churned/userId, then the others
    (bool included) except userId/churn_type - the reference's selection."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
           and f.name not in ("is_churned", "userId")]
    other = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)
             and f.name not in ("userId", "churn_type")]
    return num + other


def data_drift_report(ref: DataFrame, cur: DataFrame, threshold: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(per-feature report, one-row summary)."""
    return drift_summary(feature_drift(ref, cur, drift_features_of(cur), threshold))


def drift_summary(rep: DataFrame) -> tuple[DataFrame, DataFrame]:
    summary = rep.agg(
        F.max(F.col("drift_detected").cast("int")).cast("boolean").alias("overall_drift_detected"),
        F.count_if("drift_detected").alias("num_features_with_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("features_with_drift"),
        F.coalesce(F.max("drift_score"), F.lit(0.0)).alias("max_drift_score"),
        F.coalesce(F.avg("drift_score"), F.lit(0.0)).alias("avg_drift_score"))
    return rep, summary


# D10 ---------------------------------------------------------------------------
def side_feature_matrices(events: DataFrame, last_data_ts=None, quantile: float = 0.7,
                          materialize: bool = True, features=None) -> DataFrame:
    """Feature matrices (no cutoff; all or the named features) of both sides in ONE plan: the user key is
    prefixed with the side, so one group-by tree serves both.  The result
    (one row per user and side) is checkpointed when several drift scores
    read it."""
    s = reference_current_split(events, last_data_ts, quantile)
    keyed = s.withColumn("userId", F.concat_ws("\u0001", "side", "userId")).drop("side")
    fm = feature_matrix(keyed, None, materialize=materialize, features=features)
    parts = F.split(F.col("userId"), "\u0001")
    out = fm.withColumn("side", parts.getItem(0)).withColumn("userId", parts.getItem(1))
    return staged(out) if materialize else out


def engineered_drift(events: DataFrame, last_data_ts=None, quantile: float = 0.7, k: int = 10,
                     threshold: float = 0.1, variant: str = "monitor") -> tuple[DataFrame, DataFrame]:
    """PSI of the first ``k`` contract features between the reference and the
    current feature matrices; (per-feature scores, one-row report)."""
    contract = events.sparkSession.createDataFrame([], ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES))
    feats = numeric_feature_select(contract, contract, k)   # F8: contract order, first k; no other column is built
    fm = side_feature_matrices(events, last_data_ts, quantile, features=feats)
    st = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in feats]).alias("f"),
                                F.array(*[F.col(c) for c in feats]).alias("v")))
    long = fm.select("side", st.alias("p")).select("side", F.col("p.f").alias("feature"),
                                                    F.col("p.v").alias("value")).filter(F.col("value").isNotNull())
    psi = (psi_monitor(long) if variant == "monitor" else psi_retrain(long))
    psi = psi.withColumn("drift_detected", F.col("psi") > threshold)
    sides = fm.groupBy().agg(F.count_if(F.col("side") == CUR).alias("current_users"))
    report = psi.agg(F.max("psi").alias("max_drift_score"), F.count_if("drift_detected").alias("features_with_drift"),
                     F.max(F.col("drift_detected").cast("int")).alias("_any"))
    report = combine_rows(report, sides).select(
        (F.coalesce(F.col("_any"), F.lit(0)) == 1).alias("drift_detected"),
        F.coalesce("max_drift_score", F.lit(0.0)).alias("max_drift_score"),
        "features_with_drift", F.lit(threshold).alias("threshold"),
        F.when(F.col("current_users") == 0, F.lit("no_new_data")).alias("reason"))
    return psi, report


# D11 ---------------------------------------------------------------------------
DEFAULT_REFERENCE_PERFORMANCE = {"accuracy": 0.9, "precision": 0.9, "recall": 0.85}


def concept_drift(scored: DataFrame, label: str = "is_churned", prob: str = "churn_probability",
                  reference=None, max_drop: float = 0.1) -> DataFrame:
    ref = reference or DEFAULT_REFERENCE_PERFORMANCE
    if label not in scored.columns:
        return scored.sparkSession.range(1).select(F.lit(False).alias("concept_drift_detected"),
                                                   F.lit("no_ground_truth").alias("reason"))
    y = F.col(label).cast("int")
    pred = (F.col(prob) > 0.5).cast("int")
    c = scored.agg(F.avg((y == pred).cast("double")).alias("accuracy"),
                   (F.sum(y * pred) / F.greatest(F.sum(pred), F.lit(1))).alias("precision"),
                   (F.sum(y * pred) / F.greatest(F.sum(y), F.lit(1))).alias("recall"))
    drops = {m: F.lit(float(ref[m])) - F.col(m) for m in ("accuracy", "precision", "recall")}
    return c.select("accuracy", "precision", "recall",
                    *[d.alias(f"{m}_drop") for m, d in drops.items()],
                    ((drops["accuracy"] > max_drop) | (drops["precision"] > max_drop)
                     | (drops["recall"] > max_drop)).alias("concept_drift_detected"),
                    F.lit(None).cast("string").alias("reason"))


# D12 ---------------------------------------------------------------------------
def event_rate_proxy_from_rates(rates: DataFrame, first_current_day, threshold: float = 0.1) -> DataFrame:
    """:func:`event_rate_proxy` from day rows (T2) alone: sides are days before and from ``first_current_day``.

    Users of a side are the merged sketches of its days (standard error 0.8 %),
    so no event is read again.
    """
    side = F.when(F.to_date("day_start") < F.lit(first_current_day), REF).otherwise(CUR)
    sides = rates.groupBy(side.alias("side")).agg(F.sum("events").alias("events"),
                                                  F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
    one = [F.coalesce(F.max(F.when(F.col("side") == s, F.col(c))), F.lit(0)).alias(f"{p}_{c}")
           for s, p in ((REF, "ref"), (CUR, "cur")) for c in ("events", "users")]
    return _rate_change(sides.agg(*one), threshold)


def event_rate_proxy(split_events: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Events per distinct user on each side and the relative change."""
    ev = split_events.groupBy().agg(F.count_if(is_ref()).alias("ref_events"), F.count_if(is_cur()).alias("cur_events"))
    us = (split_events.select("side", "userId").distinct().groupBy()
          .agg(F.count_if(is_ref()).alias("ref_users"), F.count_if(is_cur()).alias("cur_users")))
    return _rate_change(combine_rows(ev, us), threshold)


def _rate_change(j: DataFrame, threshold: float) -> DataFrame:
    """Rates and their change from one row of ref_events, cur_events, ref_users, cur_users."""
    rr = F.when(F.col("ref_events") > 0, F.col("ref_events") / F.col("ref_users")).otherwise(F.lit(0.0))
    cr = F.when(F.col("cur_events") > 0, F.col("cur_events") / F.col("cur_users")).otherwise(F.lit(0.0))
    j = j.select(rr.alias("reference_event_rate"), cr.alias("current_event_rate"))
    ch = F.when(F.col("reference_event_rate") > 0,
                F.abs(F.col("current_event_rate") - F.col("reference_event_rate")) / F.col("reference_event_rate")) \
        .otherwise(F.lit(0.0))
    return j.withColumn("event_rate_change", ch).withColumn("performance_degradation", ch > threshold)
