"""Classifier evaluation: score histogram, running totals, ROC / PR curves, exact AUC, confusion.

Nothing here sorts or windows raw rows globally. Scores are first reduced
to a histogram (one row per distinct, optionally rounded, score with its
positive and negative counts; partial + final aggregate). Running totals
over that histogram are computed per score bucket -- buckets are score
ranges cut at approximate quantiles of the distinct scores -- and each
bucket's offset comes from the bucket totals, a table with at most
``buckets`` rows. So even exact curves over millions of distinct scores
never put all rows into one task.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.schemas import CONFUSION_THRESHOLD
from loanlens.session import checkpointed, local_rows

DEFAULT_BUCKETS = None  # None: the session's spark.sql.shuffle.partitions


def usable(df: DataFrame, label_col: str = "label", score: Column | str = "score", keep: list[str] | None = None) -> DataFrame:
    """``(label, score)`` of the rows that can be evaluated: a label, and a score that is neither null nor NaN.

    The one rule of all evaluations here. ``label`` is 1 above 0.5, else 0. Columns ``keep`` come first.
    """
    s = (F.col(score) if isinstance(score, str) else score).cast("double")
    y = F.col(label_col).cast("double")
    return (
        df.select(*(keep or []), F.when(y > 0.5, 1).when(y.isNotNull(), 0).alias("label"), s.alias("score"))
        .where("label is not null and score is not null and not isnan(score)")
    )


def evaluated_rows(df: DataFrame, label_col: str = "label", score: Column | str = "score") -> DataFrame:
    """One row ``(n_used, n_left_out)``: rows that :func:`usable` keeps and drops."""
    s = (F.col(score) if isinstance(score, str) else score).cast("double")
    ok = F.col(label_col).isNotNull() & s.isNotNull() & ~F.isnan(s)
    return df.agg(F.count_if(ok).alias("n_used"), F.count_if(~ok).alias("n_left_out"))


def probability_score(prob_col: str = "probability") -> Column:
    """Probability of the positive class from a classifier's probability vector."""
    return vector_to_array(F.col(prob_col)).getItem(1)


def score_histogram(
    df: DataFrame, label_col: str = "label", score: Column | str = "score", digits: int | None = None
) -> DataFrame:
    """``(score, pos, neg)``: label counts per distinct score (rounded to ``digits`` if given).

    Rows without a label or a score have no position on the curve (:func:`usable`).
    """
    rows = usable(df, label_col, score)
    if digits is not None:
        rows = rows.withColumn("score", F.round("score", digits))
    return rows.groupBy("score").agg(F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg"))


def _bucketed(hist: DataFrame, buckets: int | None) -> DataFrame:
    """Add ``bucket``: contiguous score ranges with roughly equal numbers of distinct scores."""
    buckets = buckets or int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = hist.approxQuantile("score", [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets)) if buckets > 1 else []
    inner = sorted({c for c in cuts if c not in (float("-inf"), float("inf"))})
    if not inner:
        return hist.withColumn("bucket", F.lit(0.0))
    splits = [float("-inf")] + inner + [float("inf")]
    return Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(hist)


def running_totals(
    hist: DataFrame,
    value_cols: list[str],
    descending: bool = True,
    buckets: int | None = DEFAULT_BUCKETS,
) -> tuple[DataFrame, dict[str, int]]:
    """Inclusive running sums of ``value_cols`` over ``score`` order, plus grand totals.

    Returns ``(frame with cum_<col> columns, {col: total})``. Exact for any
    bucket count; the bucket count only sets parallelism.
    """
    b = _bucketed(hist, buckets)
    totals = b.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in value_cols]).collect()
    order = sorted(totals, key=lambda r: r["bucket"], reverse=descending)
    running = {c: 0 for c in value_cols}
    offsets = []
    for r in order:
        offsets.append((float(r["bucket"]), *(running[c] for c in value_cols)))
        for c in value_cols:
            running[c] += int(r[c] or 0)
    s = F.col("score").desc() if descending else F.col("score").asc()
    w = Window.partitionBy("bucket").orderBy(s).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = local_rows(hist.sparkSession, offsets, ", ".join(["bucket double", *(f"_before_{c} bigint" for c in value_cols)]))
    joined = b.join(F.broadcast(before), "bucket")  # one row per bucket
    cols = [(F.sum(c).over(w) + F.col(f"_before_{c}")).cast("bigint").alias(f"cum_{c}") for c in value_cols]
    return joined.select("score", *value_cols, *cols), running


def curve_table(
    df: DataFrame,
    label_col: str = "label",
    score: Column | str = "score",
    digits: int | None = None,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """ROC and PR points, one per threshold (distinct score; rounded to ``digits`` if asked), highest threshold first.

    ``(threshold, tp, fp, tpr, fpr, precision, recall)`` where a row is
    predicted positive when its score is at least the threshold.
    """
    hist = checkpointed(score_histogram(df, label_col, score, digits))
    cum, totals = running_totals(hist, ["pos", "neg"], descending=True, buckets=buckets)
    p, n = totals["pos"], totals["neg"]
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return cum.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        (tp / F.lit(p) if p else F.lit(None)).cast("double").alias("tpr"),
        (fp / F.lit(n) if n else F.lit(None)).cast("double").alias("fpr"),
        F.try_divide(tp, tp + fp).cast("double").alias("precision"),
        (tp / F.lit(p) if p else F.lit(None)).cast("double").alias("recall"),
    )


POINTS = 1000
MAX_CUT_GROUPS = 4096  # groups whose cuts are broadcast: 33 MB at 1,001 scores each


def score_cuts(rows: DataFrame, by: list[str], points: int, accuracy: int) -> DataFrame:
    """``by, cuts``: ascending scores, at most ``points`` + 1 a group: the least one and approximate quantiles.

    The quantiles come from a mergeable summary of ``accuracy`` (rank error: rows / accuracy), merged on the map side.
    """
    quantiles = F.percentile_approx("score", [i / points for i in range(1, points + 1)], accuracy)
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.min("score")), quantiles)))
    return rows.groupBy(*by).agg(cuts.alias("cuts")).where("cuts is not null")


def _cut_below(cuts: Column, score: Column, most: int) -> Column:
    """The last of ``cuts``, of which there are at most ``most``, that is not above ``score`` (binary search)."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(most.bit_length()))))
    place = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(cuts, at + s - 1) <= score, at + s).otherwise(at))
    return F.get(cuts, place - 1)


def bounded_curve(
    df: DataFrame,
    label_col: str = "label",
    score: Column | str = "score",
    by: tuple[str, ...] = (),
    points: int = POINTS,
    accuracy: int | None = None,
) -> DataFrame:
    """ROC and PR points of every group of ``by``, at most ``points`` + 1 a group whatever the number of distinct scores.

    ``(*by, threshold, n, between, tp, fp, tpr, fpr, precision, recall)``. Thresholds are scores of the data, at approximate quantiles;
    the counts at a threshold are exact (a second pass, one aggregate). ``n`` rows score from the threshold up to the next
    one, ``between`` of them above the threshold itself: at most rows * (1 / points + 2 / accuracy) + 1. Nulls in ``by`` are one group, and
    a group without a usable row has no points. Nothing is as large as the distinct scores.
    """
    by = list(by)
    accuracy = accuracy or 10 * points
    rows = usable(df, label_col, score, keep=by)
    cuts = checkpointed(score_cuts(rows, by, points, accuracy))
    if by:
        names = [f"_cut_{k}" for k in range(len(by))]
        found = cuts.toDF(*names, "cuts")
        if cuts.count() <= MAX_CUT_GROUPS:
            found = F.broadcast(found)
        same = F.lit(True)
        for name, column in zip(names, by, strict=True):
            same = same & F.col(name).eqNullSafe(F.col(column))
        rows = rows.join(found, same).drop(*names)
    else:
        one = cuts.first()  # one row of at most points + 1 scores
        rows = rows.withColumn("cuts", F.lit(one["cuts"] if one else []).cast("array<double>"))
    cells = (
        rows.withColumn("threshold", _cut_below(F.col("cuts"), F.col("score"), points + 1))
        .groupBy(*by, "threshold")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") > F.col("threshold")).alias("between"), F.sum("label").cast("bigint").alias("pos"))
    )
    group = Window.partitionBy(*by)  # at most points + 1 rows a group
    down = group.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tp, fp = F.sum("pos").over(down), F.sum(F.col("n") - F.col("pos")).over(down)
    tpr = F.try_divide(tp, F.sum("pos").over(group)).cast("double")
    return cells.select(
        *by,
        "threshold",
        "n",
        "between",
        tp.alias("tp"),
        fp.alias("fp"),
        tpr.alias("tpr"),
        F.try_divide(fp, F.sum(F.col("n") - F.col("pos")).over(group)).cast("double").alias("fpr"),
        F.try_divide(tp, tp + fp).cast("double").alias("precision"),
        tpr.alias("recall"),
    )


def curve_bounds(curve: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, n_pos, n_neg, points, widest, auc_low, auc, auc_high)`` of ``bounded_curve``'s points.

    ``widest`` is the most rows that score between two neighbouring thresholds. The exact area lies between
    ``auc_low`` and ``auc_high``, since the curve only rises between two points; ``auc`` is the trapezoid's. Null areas: one class only.
    """
    down = Window.partitionBy(*by).orderBy(F.desc("threshold"))
    before = lambda c: F.lag(c, 1, 0).over(down)
    steps = curve.select(*by, "threshold", "between", "tp", "fp", before("tp").alias("_tp"), (F.col("fp") - before("fp")).alias("_d"))
    area = lambda height: F.try_divide(F.sum(F.col("_d") * height.cast("double")), F.max("tp").cast("double") * F.max("fp"))
    return steps.groupBy(*by).agg(
        F.max("tp").alias("n_pos"),
        F.max("fp").alias("n_neg"),
        F.count(F.lit(1)).alias("points"),
        F.max("between").alias("widest"),
        area(F.col("_tp")).alias("auc_low"),
        area((F.col("_tp") + F.col("tp")) / 2).alias("auc"),
        area(F.col("tp")).alias("auc_high"),
    )


def roc_curve(df: DataFrame, label_col: str = "label", score: Column | str = "score", digits: int | None = None, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    return curve_table(df, label_col, score, digits, buckets).select("threshold", "tp", "fp", "tpr", "fpr")


def pr_curve(df: DataFrame, label_col: str = "label", score: Column | str = "score", digits: int | None = None, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    return curve_table(df, label_col, score, digits, buckets).select("threshold", "tp", "fp", "precision", "recall")


def exact_auc(
    df: DataFrame,
    label_col: str = "label",
    score: Column | str = "score",
    digits: int | None = None,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """Area under ROC by the rank-sum (Mann-Whitney) formula, ties counted half.

    One row ``(n_pos, n_neg, auc)``. Exact for the (optionally rounded) scores.
    """
    hist = checkpointed(score_histogram(df, label_col, score, digits))
    cum, totals = running_totals(hist, ["neg", "pos"], descending=False, buckets=buckets)
    p, n = totals["pos"], totals["neg"]
    below = F.col("cum_neg") - F.col("neg")
    num = F.sum(F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") / 2))
    denom = float(p) * float(n)
    auc = num / F.lit(denom) if denom > 0 else F.lit(None).cast("double")
    return cum.agg(auc.alias("auc")).select(
        F.lit(int(p)).cast("bigint").alias("n_pos"), F.lit(int(n)).cast("bigint").alias("n_neg"), "auc"
    )


def confusion_at_threshold(
    df: DataFrame, label_col: str = "label", score: Column | str = "score", threshold: float = CONFUSION_THRESHOLD
) -> DataFrame:
    """``(label, predicted, n)``, always four rows, with predicted = 1 when the score exceeds the threshold.

    One global aggregate of four conditional counts over the :func:`usable` rows.
    """
    predicted = (F.col("score") > F.lit(threshold)).cast("int")
    cells = [(y, p) for y in (0, 1) for p in (0, 1)]
    one = usable(df, label_col, score).agg(*(F.count_if((F.col("label") == y) & (predicted == p)).alias(f"_{y}{p}") for y, p in cells))
    rows = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(f"_{y}{p}").alias("n")) for y, p in cells]
    return one.select(F.inline(F.array(*rows)))


def evaluator_metrics(predictions: DataFrame, label_col: str = "label", raw_col: str = "rawPrediction") -> dict[str, float]:
    """Area under ROC and PR from ``BinaryClassificationEvaluator`` (binned, 1000 bins)."""
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=raw_col)
    return {
        "areaUnderROC": ev.evaluate(predictions, {ev.metricName: "areaUnderROC"}),
        "areaUnderPR": ev.evaluate(predictions, {ev.metricName: "areaUnderPR"}),
    }
