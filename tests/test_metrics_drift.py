import numpy as np
import pytest

from ebbline.operators import drift as D
from ebbline.operators import evaluate as V


def _trapz(x, y):
    x, y = np.asarray(x, float), np.asarray(y, float)
    return float(np.sum((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2))


def _brute_curves(y, s):
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps, fps = np.cumsum(y)[idx], (1 + idx) - np.cumsum(y)[idx]
    P, N = tps[-1], fps[-1]
    roc = _trapz(np.r_[0, fps / N], np.r_[0, tps / P])
    prec, rec = tps / (tps + fps), tps / P
    pr = abs(_trapz(np.r_[rec[::-1], 0], np.r_[prec[::-1], 1]))
    r90 = max([r for p, r in zip(prec, rec) if p >= 0.9], default=0.0)
    return roc, pr, r90


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_recall_at_precision_vs_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(y * 0.3 + rng.random(400) * 0.7, 0, 1), 2)   # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    roc, pr, r90 = _brute_curves(y, s)
    rep = V.classification_report(df).first()
    assert rep.roc_auc == pytest.approx(roc, abs=1e-12)
    assert rep.pr_auc == pytest.approx(pr, abs=1e-12)
    assert rep.recall_at_90_precision == pytest.approx(r90, abs=1e-12)


def test_ks_and_psi_against_numpy(spark):
    rng = np.random.default_rng(0)
    ref, cur = rng.normal(0, 1, 300), np.r_[rng.normal(0.3, 1.2, 200), [10.0]]
    long = spark.createDataFrame([("reference", "x", float(v)) for v in ref] + [("current", "x", float(v)) for v in cur],
                                 "side string, feature string, value double")
    allv = np.r_[ref, cur]
    cdf1 = np.searchsorted(np.sort(ref), allv, side="right") / len(ref)
    cdf2 = np.searchsorted(np.sort(cur), allv, side="right") / len(cur)
    assert D.ks_numeric(long).first().ks_statistic == pytest.approx(np.max(np.abs(cdf1 - cdf2)), abs=1e-12)
    edges = np.histogram(ref, bins=10)[1]
    e = np.histogram(ref, bins=edges)[0] / len(ref)
    a = np.histogram(cur, bins=edges)[0] / len(cur)
    e, a = np.where(e == 0, 0.0001, e), np.where(a == 0, 0.0001, a)
    assert D.psi_monitor(long).first().psi == pytest.approx(float(np.sum((a - e) * np.log(a / e))), abs=1e-12)
    rc, cc = np.histogram(ref, bins=edges)[0], np.histogram(cur, bins=edges)[0]
    rp, cp = (rc + 1e-6) / (rc.sum() + 1e-5), (cc + 1e-6) / (cc.sum() + 1e-5)
    assert D.psi_retrain(long).first().psi == pytest.approx(abs(float(np.sum((cp - rp) * np.log(cp / rp)))), abs=1e-12)


def test_identity_gives_zero_and_ks_bounds(spark):
    vals = [float(v) for v in np.random.default_rng(5).integers(0, 20, 200)]
    long = spark.createDataFrame([(side, "x", v) for side in ("reference", "current") for v in vals],
                                 "side string, feature string, value double")
    assert D.ks_numeric(long).first().ks_statistic == 0.0
    assert D.psi_monitor(long).first().psi == pytest.approx(0.0, abs=1e-15)
    cat = spark.createDataFrame([(side, "c", str(int(v))) for side in ("reference", "current") for v in vals],
                                "side string, feature string, value string")
    assert D.psi_categorical(cat).first().psi == pytest.approx(0.0, abs=1e-15)


def test_feature_drift_edge_methods(spark):
    ref = spark.createDataFrame([(1.0, "a", None), (2.0, "b", None)], "x double, c string, e double")
    cur = spark.createDataFrame([(5.0, "z", None)], "x double, c string, e double")
    rep = {r.feature: r for r in D.feature_drift(ref, cur, ["x", "c", "e", "absent"]).collect()}
    assert rep["x"].method == "kolmogorov_smirnov" and rep["x"].drift_score == 1.0 and rep["x"].drift_detected
    assert rep["c"].method == "population_stability_index"
    assert rep["e"].method == "insufficient_data" and rep["absent"].method == "missing_feature"
