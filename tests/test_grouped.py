"""Statistics of many groups in one pass, against the one-frame forms and numpy."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from test_stats import _t_sf

from loanlens.functions import linalg, special
from loanlens.operators import evaluate, grouped
from loanlens.operators.cleaning import cast_numeric
from loanlens.operators.features import prepare_model_frame
from loanlens.operators.stats import correlation_long, hypothesis_table
from loanlens.plans import jobs
from loanlens.sources import acquisition_records, performance_records


@pytest.fixture(scope="module")
def lab(spark, sf_small):
    from loanlens.session import checkpointed

    return checkpointed(jobs.labelled(acquisition_records(spark, sf_small, with_file_year=True), performance_records(spark, sf_small)))


# ---- expressions ------------------------------------------------------------------


def test_matrix_functions_equal_numpy(spark):
    rng = np.random.default_rng(0)
    given = []
    for n in (1, 2, 5, 22):
        x = rng.normal(size=(n + 30, n))
        given.append((n, (x.T @ x / 30 + 0.1 * np.eye(n)).tolist(), rng.normal(size=n).tolist()))
    df = spark.createDataFrame(given, "n int, m array<array<double>>, v array<double>")
    lower = linalg.cholesky(F.col("m"))
    rows = df.select("n", "m", "v", lower.alias("l"), linalg.gram_of_lower(linalg.lower_inverse(lower)).alias("inv"), linalg.matrix_times(F.col("m"), F.col("v")).alias("mv"))
    for r in rows.collect():
        m = np.array(r.m)
        assert [len(row) for row in r.l] == list(range(1, r.n + 1))
        triangle = np.zeros_like(m)
        for i, row in enumerate(r.l):
            triangle[i, : i + 1] = row
        assert np.allclose(triangle, np.linalg.cholesky(m)) and np.allclose(r.inv, np.linalg.inv(m)) and np.allclose(r.mv, m @ np.array(r.v))
    assert spark.range(1).select(linalg.cholesky(F.array().cast("array<array<double>>"))).first()[0] == []


def test_t_tail_equals_integration_and_the_normal_limit(spark):
    cases = [(t, d) for d in (1.0, 2.0, 5.0, 30.0, 2500.0) for t in (0.0, 0.01, -0.5, 1.0, 1.73, 1.74, 2.5, -6.0)]
    cases += [(t, d) for d in (1e6, 1e9) for t in (0.5, 1.8, 3.0, 8.0)] + [(float("inf"), 3.0), (None, 3.0), (1.0, 0.0), (float("nan"), 3.0)]
    df = spark.createDataFrame(cases, "t double, d double")
    got = {(r.t, r.d): r.p for r in df.select("t", "d", special.student_t_two_sided(F.col("t"), F.col("d")).alias("p")).collect() if r.t == r.t}
    for (t, d), p in got.items():
        if t is None or d == 0:
            assert p is None
        elif math.isinf(t):
            assert p == 0
        elif d >= 1e6:
            assert math.isclose(p, math.erfc(abs(t) / math.sqrt(2)), abs_tol=1.0 / d + 1e-8)
        elif d == 1:
            assert math.isclose(p, 1 - 2 / math.pi * math.atan(abs(t)), abs_tol=1e-9)  # Cauchy
        elif d == 2:
            assert math.isclose(p, 1 - abs(t) / math.sqrt(2 + t * t), abs_tol=1e-9)
        else:
            assert math.isclose(p, _t_sf(t, d, upper=200.0), abs_tol=2e-7)


# ---- groups ------------------------------------------------------------------------


def fitted(lab, **options):
    rows = cast_numeric(lab.withColumn("year", F.col("file_year")))
    stats = grouped.fit_groups(rows, "year", **options)
    frame = grouped.group_frame(rows, stats, ["loan_id"])
    return stats, frame, grouped.group_moments(frame, stats)


def close(a, b, tol=1e-9):
    return (a is None and b is None) or a == b or math.isclose(a, b, rel_tol=1e-6, abs_tol=tol)


def test_each_group_equals_its_own_frame(spark, lab):
    # a year without any dti and with one loan purpose; a null year
    odd = lab.withColumn("dti", F.when(F.col("file_year") == 2000, F.col("dti"))).withColumn(
        "loan_purpose", F.when(F.col("file_year") == 2000, F.col("loan_purpose")).otherwise("1")
    )
    odd = odd.withColumn("file_year", F.when(F.pmod(F.col("loan_id").cast("long"), F.lit(3)) > 0, F.col("file_year")))
    stats, frame, moments = fitted(odd)
    hypotheses, correlations = grouped.group_hypotheses(moments, stats).collect(), grouped.group_correlations(moments, stats).collect()
    values = {r.loan_id: r for r in frame.collect()}
    for year in (None, 2000, 2001):
        one = odd.where(F.col("file_year").eqNullSafe(F.lit(year)))
        mf = prepare_model_frame(one)
        at = [stats.features.index(f) for f in mf.features]
        assert len(at) == (21 if year == 2001 else 22)
        rows = mf.df.collect()
        assert len(rows) == sum(r.year == year for r in values.values())
        for r in rows:
            got = values[r.loan_id]
            assert all(close(got.out[i], r[f"out_{f}"]) and close(got.z[i], r[f"z_{f}"]) for i, f in zip(at, mf.features, strict=True))
            assert got.features.toArray().tolist() == got.z and got.label == r.is_foreclosed
        expected = hypothesis_table(spark, mf.df.select("scaledFeatures", "is_foreclosed"), mf.features).orderBy("position").collect()
        mine = sorted((r for r in hypotheses if r.year == year), key=lambda r: r.position)
        assert [(r.position, r.feature) for r in mine] == [(r.position, r.feature) for r in expected]
        for a, b in zip(mine, expected, strict=True):
            assert all(close(a[c], b[c], 1e-7) for c in ("coefficient", "std_error", "t", "p", "p_bonferroni", "p_bonferroni_capped")), (year, a, b)
        r_of = {(r.feature_a, r.feature_b): r.r for r in correlation_long(mf.df, [f"out_{f}" for f in mf.features]).collect()}
        mine = {(r.feature_a, r.feature_b): r.r for r in correlations if r.year == year}
        assert mine.keys() == r_of.keys() and all(close(mine[k], r_of[k]) for k in mine)


def test_columns_with_many_values_are_joined(spark, lab):
    _, inline, _ = fitted(lab)
    stats, joined, _ = fitted(lab, max_inline=3)
    assert stats.large.keys() >= {"loan_purpose", "seller_name"} and "product_type" not in stats.large
    assert {r.loan_id: r.z for r in inline.collect()} == {r.loan_id: r.z for r in joined.collect()}


def test_one_label_class_and_empty_input(spark, lab):
    none = lab.withColumn("is_foreclosed", F.lit(0))
    stats, _, moments = fitted(none)
    rows = grouped.group_hypotheses(moments, stats).collect()
    assert len(rows) == 2 * 23 and all(r.coefficient == 0 and r.p is None and r.std_error is None for r in rows)
    stats, frame, moments = fitted(lab.limit(0))
    assert frame.count() == 0 and grouped.group_hypotheses(moments, stats).count() == 0
    single, frame, moments = fitted(lab.limit(1))
    assert all(z == 0 for z in frame.first().z) and grouped.group_hypotheses(moments, single).count() > 1


def scored(spark):
    rng = np.random.default_rng(3)
    rows = []
    for year, n in ((2000, 900), (2001, 40), (None, 300)):
        for model in ("a", "b"):
            s = np.round(rng.random(n), 2 if model == "a" else 9)
            y = (rng.random(n) < s).astype(int)
            rows += [(year, model, int(a), float(b)) for a, b in zip(y, s, strict=True)]
    rows += [(2000, "a", None, 0.5), (2000, "a", 1, None), (2000, "a", 1, float("nan")), (2002, "a", 1, 0.5)]
    return spark.createDataFrame(rows, "year int, model string, label int, score double")


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_curves_and_metrics_of_each_group(spark, ranges):
    df, keys = scored(spark), ["year", "model"]
    totals = grouped.group_totals(grouped.group_histogram(df, keys), keys, ranges)
    curves = grouped.group_curves(totals, keys).collect()
    metrics = {(r.year, r.model, r.metric): r.value for r in grouped.group_metrics(totals, keys).collect()}
    confusion = grouped.group_confusion(df, keys).collect()
    assert metrics[(2002, "a", "areaUnderROC")] is None and metrics[(2002, "a", "testRows")] == 1
    for year in (2000, 2001, None):
        for model in ("a", "b"):
            one = evaluate.usable(df.where(F.col("year").eqNullSafe(F.lit(year)) & (F.col("model") == model)))
            expected = sorted(map(tuple, evaluate.curve_table(one).collect()))
            assert sorted(tuple(r)[2:] for r in curves if (r.year, r.model) == (year, model)) == expected
            assert sorted(tuple(r)[2:] for r in confusion if (r.year, r.model) == (year, model)) == sorted(map(tuple, evaluate.confusion_at_threshold(one).collect()))
            raw = one.select(F.col("label").cast("double").alias("label"), "score")
            exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
            for name in ("areaUnderROC", "areaUnderPR"):
                assert math.isclose(metrics[(year, model, name)], exact.evaluate(raw, {exact.metricName: name}), rel_tol=1e-9)
            assert math.isclose(metrics[(year, model, "exactAUC")], evaluate.exact_auc(one).first().auc, rel_tol=1e-12)


def test_number_of_jobs_does_not_grow_with_years(spark, lab):
    def run(years):
        spark.sparkContext.setJobGroup(f"years-{years}", "")
        try:
            rows = lab.withColumn("file_year", F.lit(2000) + F.pmod(F.col("loan_id").cast("long"), F.lit(years)).cast("int"))
            frame = jobs.year_frame(rows)
            found = grouped.group_hypotheses(frame.moments, frame.stats).select("year").distinct().count()
            grouped.group_correlations(frame.moments, frame.stats).count()
            data = frame.data.select("year", "label", F.get("z", F.lit(11)).alias("score"))
            totals = grouped.group_totals(grouped.group_histogram(data, ["year"]), ["year"])
            assert grouped.group_metrics(totals, ["year"]).count() == 4 * found
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found == years
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"years-{years}"))

    few, many = run(2), run(9)
    assert many <= few + 2  # adaptive execution may split a job, whatever the years
