"""Grouped Newton logistic regression against the pyspark.ml fit."""

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from loanlens.operators import newton
from loanlens.plans import jobs
from loanlens.schemas import MODEL_FEATURES
from loanlens.sources import acquisition_records, performance_records


def test_fit_equals_the_ml_fit_of_each_year(spark, sf_small):
    lab = jobs.labelled(acquisition_records(spark, sf_small, with_file_year=True), performance_records(spark, sf_small))
    lab = lab.withColumn("file_year", F.when(F.col("file_year") == 2000, F.lit(2000)))  # the other year has no name
    frame = jobs.year_frame(lab)
    fitted = newton.fit_logistic_groups(frame.data, "year", len(MODEL_FEATURES))
    table = {(r.year, r.position): r.coefficient for r in newton.coefficient_table(fitted, "year", frame.stats.features).collect()}
    scores = newton.score_groups(frame.data, fitted, "year", ["loan_id"]).collect()
    assert {r.year for r in fitted.collect()} == {2000, None} and len(table) == 2 * (len(MODEL_FEATURES) + 1)
    for year in (2000, None):
        rows = frame.data.where(F.col("year").eqNullSafe(F.lit(year)))
        ml = LogisticRegression(regParam=newton.REG, standardization=False, tol=1e-14, maxIter=1000).fit(rows)
        expected = [*ml.coefficients.toArray(), ml.intercept]
        assert all(abs(table[(year, i)] - v) < 1e-6 for i, v in enumerate(expected)), year
        probability = {r.loan_id: r.probability[1] for r in ml.transform(rows).collect()}
        mine = {r.loan_id: r.score for r in scores if r.year == year}
        assert mine.keys() == probability.keys() and all(math.isclose(mine[k], probability[k], abs_tol=1e-7) for k in mine)
    other = newton.fit_logistic_groups(frame.data.repartition(5, "loan_id"), "year", len(MODEL_FEATURES))
    again = {(r.year, r.position): r.coefficient for r in newton.coefficient_table(other, "year", frame.stats.features).collect()}
    assert all(abs(again[k] - table[k]) < 1e-12 for k in table)  # whatever the layout
    assert newton.fit_logistic_groups(frame.data.limit(0), "year", len(MODEL_FEATURES), rounds=2).count() == 0


def test_a_round_makes_one_line_an_input_of_each_row(spark, sf_small, monkeypatch):
    """Not one a cell of the Hessian; missing numbers add nothing, in whatever form."""
    frames = []
    keep = newton.checkpointed
    monkeypatch.setattr(newton, "checkpointed", lambda df: frames.append(df) or keep(df))
    rows = [(2000 + i % 2, [float(i % 5) - 2, float(i % 3)] if i % 7 else [None, 1.0], int(i % 4 == 0)) for i in range(200)]
    data = spark.createDataFrame(rows, "year int, z array<double>, label int")
    got = {r.year: r for r in newton.fit_logistic_groups(data, "year", 2, rounds=6).collect()}
    filled = data.withColumn("z", F.transform("z", lambda v: F.coalesce(v, F.lit(0.0))))
    same = {r.year: r for r in newton.fit_logistic_groups(filled, "year", 2, rounds=6).collect()}
    assert got.keys() == {2000, 2001}
    assert all(got[y].n == 100 and all(abs(a - b) < 1e-12 for a, b in zip(got[y].coefficients, same[y].coefficients)) for y in got)
    plan = frames[1]._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "Generate" in x]
    assert len(lines) == 1 and "posexplode(concat(z" in lines[0]
