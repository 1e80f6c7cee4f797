import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanlens.operators.models import hash_split, hash_split_column
from loanlens.plans import jobs
from loanlens.sources import acquisition_records, performance_records


def test_hash_split_is_disjoint_complete_and_stable(spark, sf_small):
    acq = acquisition_records(spark, sf_small)
    train, test = hash_split(acq)
    a = {r["loan_id"] for r in train.select("loan_id").collect()}
    b = {r["loan_id"] for r in test.select("loan_id").collect()}
    assert not (a & b) and len(a | b) == 1500
    assert 0.65 < len(a) / 1500 < 0.75
    train2, _ = hash_split(acq.repartition(11))
    assert {r["loan_id"] for r in train2.select("loan_id").collect()} == a
    three = acq.select(hash_split_column("loan_id", (1, 1, 2), ("x", "y", "z")).alias("s")).groupBy("s").count()
    assert {r["s"] for r in three.collect()} == {"x", "y", "z"}


def test_models_score_the_test_side(spark, sf_small):
    lab = jobs.labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small))
    md = jobs.model_data(lab)
    _, test = hash_split(md.data)
    n_test = test.count()
    for name in ("logistic_regression", "gradient_boosted_trees", "random_forest"):
        _, pred = jobs.fit_model(name, md.data)
        m = {r["metric"]: r["value"] for r in jobs.model_metrics(spark, name, pred).collect()}
        exact = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
        assert m["exactAUC"] == pytest.approx(exact.evaluate(pred.withColumn("label", F.col("label").cast("double"))), abs=1e-12)
        assert m["testRows"] == n_test == pred.count()
    counts = {r["split"]: r["n_rows"] for r in jobs.split_counts(lab).collect()}
    assert counts["test"] == n_test and sum(counts.values()) == lab.count()


def test_logistic_against_numpy(spark, sf_small):
    """Scores are the sigmoid of the fitted coefficients, and the fit is close to the likelihood's maximum."""
    md = jobs.model_data(jobs.labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small)))
    model, pred = jobs.fit_model("logistic_regression", md.data)
    train, test = hash_split(md.data)
    x = np.array([r["features"].toArray() for r in test.orderBy("loan_id").collect()])
    score = np.array([r["score"] for r in pred.orderBy("loan_id").collect()])
    assert np.allclose(score, 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept))), atol=1e-12)
    rows = train.collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows], dtype=float)
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    for _ in range(50):  # Newton steps with a small ridge: some inputs are constant
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-6 * np.eye(len(w)), x1.T @ (p - y) + 1e-6 * w)
    loss = lambda w: np.mean(np.logaddexp(0, x1 @ w) - y * (x1 @ w))
    fitted = np.append(model.coefficients.toArray(), model.intercept)
    assert loss(w) <= loss(fitted) + 1e-9 and loss(fitted) < 1.03 * loss(w)


def test_logistic_is_deterministic(spark, sf_small):
    lab = jobs.labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small))
    md = jobs.model_data(lab)
    m1, _ = jobs.fit_model("logistic_regression", md.data)
    m2, _ = jobs.fit_model("logistic_regression", md.data.repartition(5))
    assert all(abs(a - b) < 1e-9 for a, b in zip(m1.coefficients, m2.coefficients))


def test_forest_does_not_depend_on_input_partitioning(spark, sf_small):
    lab = jobs.labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small))
    md = jobs.model_data(lab)
    train, _ = hash_split(md.data)
    from loanlens.operators.models import fit_forest

    body = lambda m: m.toDebugString.split("\n", 1)[1]  # first line carries the model uid
    a = fit_forest(train.repartition(3), partitions=8)
    b = fit_forest(train.repartition(7).orderBy("label"), partitions=8)
    assert body(a) == body(b)
    # the layout is fixed, it depends neither on the number of rows nor, not on spark.sql.shuffle.partitions
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        c = fit_forest(train.repartition(5))
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        d = fit_forest(train.repartition(2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    assert body(c) == body(d)


def test_logistic_scores_after_a_reconciled_read_and_an_observation(spark, sf_small, tmp_path):
    """Neither keeps the scoring tasks from being sent."""
    from pyspark.sql import Observation

    from loanlens.session import build_session
    from loanlens.sources import text

    assert "Observation(" not in open(text.__file__).read()
    path = str(tmp_path / "lines")
    spark.createDataFrame([("1|a|b",), ("2|a",), ("3|a|b|c",)], "value string").write.text(path)
    read = text.read_reconciled(spark, path, ["loan_id", "x", "y"])
    assert read.counts == {"lines": 3, "good": 1, "short": 1, "wide": 1, "rows": 1, "rejected": 2}
    md = jobs.model_data(jobs.labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small)))
    other = build_session().newSession()  # an observation leaves its mark on this session alone
    data = other.read.parquet(*md.data.inputFiles())
    seen = Observation()
    data.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "seen"))
    model, pred = jobs.fit_model("logistic_regression", data)
    assert not model.hasSummary and seen.get["n"] == data.count() and pred.count() > 0
