import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanlens.operators import evaluate
from loanlens.operators.models import split_fraction
from loanlens.plans.jobs import labelled
from loanlens.sources import acquisition_records, performance_records


def _scored(spark, sf):
    lab = labelled(acquisition_records(spark, sf), performance_records(spark, sf))
    return lab.select(
        "loan_id",
        F.col("is_foreclosed").alias("label"),
        (F.lit(1.0) - F.col("min_credit_score") / 1000.0).alias("coarse"),
        split_fraction("loan_id", 3).alias("fine"),
    )


def _brute_auc(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def test_exact_auc_brute_force_and_bucket_invariance(spark, sf_small):
    df = _scored(spark, sf_small)
    pdf = df.toPandas()
    for col in ("coarse", "fine"):
        expected = _brute_auc(pdf["label"].to_numpy(), pdf[col].to_numpy())
        for b in (1, 5, 64):
            r = evaluate.exact_auc(df, "label", col, buckets=b).first()
            assert abs(r["auc"] - expected) < 1e-12, (col, b)
            assert r["n_pos"] + r["n_neg"] == len(pdf)
    ev = BinaryClassificationEvaluator(rawPredictionCol="fine", labelCol="label", numBins=0)
    assert abs(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))) - _brute_auc(
        pdf["label"].to_numpy(), pdf["fine"].to_numpy())) < 1e-12


def test_curves_monotone_and_bucket_invariant(spark, sf_small):
    df = _scored(spark, sf_small)
    a = evaluate.curve_table(df, "label", "fine", digits=3, buckets=1).orderBy(F.desc("threshold")).collect()
    b = evaluate.curve_table(df, "label", "fine", digits=3, buckets=9).orderBy(F.desc("threshold")).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    tps = [r["tp"] for r in a]
    fps = [r["fp"] for r in a]
    assert tps == sorted(tps) and fps == sorted(fps)
    assert a[-1]["tpr"] == 1.0 and a[-1]["fpr"] == 1.0
    n = df.count()
    assert a[-1]["tp"] + a[-1]["fp"] == n


def test_confusion_sums_to_n(spark, sf_small):
    df = _scored(spark, sf_small)
    conf = evaluate.confusion_at_threshold(df, "label", "coarse").collect()
    assert sum(r["n"] for r in conf) == df.count()
    pdf = df.toPandas()
    tp = int(((pdf["coarse"] > 0.415856) & (pdf["label"] == 1)).sum())
    assert {(r["label"], r["predicted"]): r["n"] for r in conf}.get((1, 1), 0) == tp


def test_exact_curve_against_brute_force(spark, sf_small):
    df = _scored(spark, sf_small)
    pdf = df.toPandas()
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in evaluate.curve_table(df, "label", "fine", digits=None, buckets=7).collect()}
    assert len(got) == pdf["fine"].nunique()
    for t, (tp, fp) in got.items():
        sel = pdf["fine"] >= t
        assert tp == int((sel & (pdf["label"] == 1)).sum()) and fp == int((sel & (pdf["label"] == 0)).sum())


def test_confusion_has_four_rows_and_one_rule_for_missing_values(spark):
    rows = [(1, 0.9), (1, None), (None, 0.9), (0, float("nan")), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    conf = {(r["label"], r["predicted"]): r["n"] for r in evaluate.confusion_at_threshold(df).collect()}
    assert conf == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1}
    hist = evaluate.score_histogram(df).agg(F.sum("pos"), F.sum("neg")).first()
    assert tuple(hist) == (1, 1)
    auc = evaluate.exact_auc(df).first()
    assert (auc["n_pos"], auc["n_neg"], auc["auc"]) == (1, 1, 1.0)
    assert tuple(evaluate.evaluated_rows(df).first()) == (2, 3)
    nothing = evaluate.confusion_at_threshold(df.where("false")).collect()
    assert [r["n"] for r in nothing] == [0, 0, 0, 0]


def test_curves_are_exact_unless_digits_are_asked_for(spark):
    df = spark.createDataFrame([(1, 0.1234), (0, 0.1233), (1, 0.1232)], "label int, score double")
    assert evaluate.curve_table(df).count() == 3 and evaluate.curve_table(df, digits=3).count() == 1


def _points(rows):
    """Exact (threshold, tp, fp) at every distinct score."""
    return {s: (sum(y for y, x in rows if x >= s), sum(1 - y for y, x in rows if x >= s)) for s in {x for _, x in rows}}


def test_bounded_curve_keeps_its_bounds(spark):
    rows = [(i % 3, (i * 7919 % 9001) / 9001 if i % 5 else 0.25, int(i * 31 % 97 < 40)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "g int, score double, label int").repartition(7)
    for points, accuracy in ((50, 500), (1000, None), (1, None)):
        curve = evaluate.bounded_curve(df, points=points, accuracy=accuracy).cache()
        got = curve.collect()
        assert len(got) <= points + 1 and sum(r["n"] for r in got) == len(rows)
        scores, labels = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        for r in got[:: max(1, len(got) // 60)]:
            above = scores >= r["threshold"]
            assert (r["tp"], r["fp"]) == (labels[above].sum(), (1 - labels[above]).sum())
        b = evaluate.curve_bounds(curve).first()
        assert (b["n_pos"], b["n_neg"], b["points"]) == (labels.sum(), (1 - labels).sum(), len(got))
        assert b["widest"] <= len(rows) * (1 / points + 2 / (accuracy or 10 * points)) + 1
        exact = _brute_auc(labels, scores)
        assert b["auc_low"] - 1e-12 <= exact <= b["auc_high"] + 1e-12 and b["auc_low"] <= b["auc"] <= b["auc_high"]
        if points == 1000:
            assert abs(b["auc"] - exact) < 1e-3


def test_bounded_curve_by_group(spark, monkeypatch):
    rows = [(None if i % 4 == 0 else i % 4, (i * 53 % 401) / 401, i % 2) for i in range(1200)]
    rows += [(9, None, 1), (9, float("nan"), 0), (8, 0.5, 1), (8, 0.5, 1)]  # a group without scores, one with a single class and score
    df = spark.createDataFrame(rows, "g int, score double, label int")
    plain = {g: _points([(y, s) for x, s, y in rows if x == g]) for g in (None, 1, 2, 3, 8)}
    results = []
    for limit in (4096, 0):  # cuts broadcast, or joined by a shuffle
        monkeypatch.setattr(evaluate, "MAX_CUT_GROUPS", limit)
        curve = evaluate.bounded_curve(df, by=("g",), points=20)
        results.append(sorted((str(r["g"]), r["threshold"], r["tp"], r["fp"]) for r in curve.collect()))
        for r in curve.collect():
            assert plain[r["g"]][r["threshold"]] == (r["tp"], r["fp"])
        bounds = {r["g"]: r for r in evaluate.curve_bounds(curve, ("g",)).collect()}
        assert set(bounds) == set(plain) and all(b["points"] <= 21 for b in bounds.values())
        assert bounds[8]["points"] == 1 and bounds[8]["auc"] is None and bounds[8]["widest"] == 0
    assert results[0] == results[1]
    assert evaluate.bounded_curve(df.where("g = 9")).count() == 0
    assert evaluate.bounded_curve(df.where("g = 9"), by=("g",)).count() == 0
    many = evaluate.bounded_curve(df, by=("g",))  # more points than scores: the exact curve
    assert {(r["g"], r["threshold"]): (r["tp"], r["fp"]) for r in many.collect()} == {(g, s): c for g, p in plain.items() for s, c in p.items()}
