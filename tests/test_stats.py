import pytest
from pyspark.sql import functions as F
import math

import numpy as np

from loanlens.operators import stats
from loanlens.plans.jobs import labelled, model_data
from loanlens.sources import acquisition_records, performance_records


def _t_sf(t, dof, upper=80.0, steps=400001):
    """Two-sided Student-t tail by numeric integration (no scipy available)."""
    t = abs(t)
    if t >= upper:
        return 0.0
    x = np.linspace(t, upper, steps)
    logc = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    f = np.exp(logc - (dof + 1) / 2 * np.log1p(x * x / dof))
    return float(2 * np.trapezoid(f, x))


def test_glm_matches_closed_form(spark, sf_small):
    md = model_data(labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small)))
    rows = md.data.select("features", "label").collect()
    X = np.array([r["features"].toArray() for r in rows])
    y = np.array([float(r["label"]) for r in rows])
    n, p = X.shape
    data = md.data.selectExpr("features AS scaledFeatures", "label AS is_foreclosed")
    table = {r["position"]: r for r in stats.hypothesis_table(spark, data, md.frame.features).collect()}

    sx = X.std(axis=0)
    live = sx > 0
    Z = X[:, live] / sx[live]
    lam = 0.3 / y.std()
    A = Z.T @ Z / n + lam * np.eye(Z.shape[1])
    inv = np.linalg.inv(A)
    beta = inv @ (Z.T @ (y - y.mean()) / n)
    coef = np.zeros(p)
    coef[live] = beta / sx[live]
    intercept = y.mean() - X.mean(axis=0) @ coef
    rss = float(((y - intercept - X @ coef) ** 2).sum())
    dof = n - p - 1
    disp = rss / dof
    se = np.full(p, np.inf)
    se[live] = np.sqrt(disp * np.diag(inv) / n) / sx[live]

    for j in range(p):
        r = table[j]
        assert math.isclose(r["coefficient"], coef[j], rel_tol=1e-6, abs_tol=1e-10)
        if live[j]:
            assert math.isclose(r["std_error"], se[j], rel_tol=1e-6)
            assert math.isclose(r["t"], coef[j] / se[j], rel_tol=1e-6, abs_tol=1e-9)
            assert math.isclose(r["p"], _t_sf(coef[j] / se[j], dof), abs_tol=1e-6)
        else:
            assert r["coefficient"] == 0.0 and math.isinf(r["std_error"]) and r["p"] == 1.0
        assert r["p_bonferroni"] == r["p"] * p
        assert r["p_bonferroni_capped"] == min(r["p"] * p, 1.0) >= r["p"]
    assert math.isclose(table[p]["coefficient"], intercept, rel_tol=1e-9)
    assert math.isclose(table[p]["std_error"], math.sqrt(disp / n), rel_tol=1e-6)


def test_correlation_matches_numpy(spark, sf_small):
    md = model_data(labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small)))
    cols = [f"out_{c}" for c in md.frame.features]
    corr = stats.correlation_long(md.data, cols, readable=False, lower_only=False)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in corr.collect()}
    M = md.data.select(*cols).toPandas().to_numpy()
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            va, vb = M[:, i], M[:, j]
            if va.std() == 0 or vb.std() == 0:
                assert got[(a, b)] is None
            else:
                assert math.isclose(got[(a, b)], np.corrcoef(va, vb)[0, 1], abs_tol=1e-9)
    lower = stats.correlation_long(md.data, cols)
    assert lower.count() == len(cols) * (len(cols) - 1) // 2
    sql_form = {(r["feature_a"], r["feature_b"]): r["r"] for r in stats.correlation_long(md.data, cols, method="sql").collect()}
    for r in lower.collect():
        a, b = sql_form[(r["feature_a"], r["feature_b"])], r["r"]
        assert (a is None and b is None) or abs(a - b) < 1e-9


def test_bonferroni(spark):
    df = spark.createDataFrame([(0.01,), (0.2,)], "p double")
    got = [(r["p_bonferroni"], r["p_bonferroni_capped"]) for r in stats.bonferroni(df, 10).collect()]
    assert got == [(0.1, 0.1), (2.0, 1.0)]


def test_missing_cells_are_an_error_in_both_correlation_forms(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0)], "a double, b double")
    for method in ("ml", "sql"):
        with pytest.raises(Exception, match="(?i)null|missing"):
            stats.correlation_long(df, ["a", "b"], readable=False, method=method).collect()


def test_glm_moments_give_the_fit(spark, sf_small):
    """The ridge solution from the moments alone equals the distributed fit."""
    md = model_data(labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small)))
    feats = md.frame.features
    m = {(r["moment"], r["a"], r["b"]): r["value"] for r in stats.glm_moments(md.frame.df, feats).collect()}
    n, p = m[("n", "", "")], len(feats)
    xx = np.zeros((p, p))
    for i, a in enumerate(feats):
        for j in range(i + 1):
            xx[i, j] = xx[j, i] = m[("xx", a, feats[j])]
    mean = np.array([m[("mean", f, "")] for f in feats])
    y = m[("mean", "is_foreclosed", "")]
    xy = np.array([m[("xy", f, "is_foreclosed")] for f in feats])
    cov, cxy = xx / n - np.outer(mean, mean), xy / n - mean * y
    used = np.flatnonzero(np.diag(cov) > 1e-12)
    coef = np.zeros(p)
    coef[used] = np.linalg.solve(cov[np.ix_(used, used)] + 0.3 / (y * (1 - y)) ** 0.5 * np.diag(np.diag(cov)[used]), cxy[used])
    hyp = md.data.select(F.col("features").alias("scaledFeatures"), F.col("label").alias("is_foreclosed"))
    table = stats.hypothesis_table(spark, hyp, feats).orderBy("position").collect()
    assert np.allclose([r["coefficient"] for r in table[:p]], coef, atol=1e-6)
