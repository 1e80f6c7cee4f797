"""Feature statistics, correlations, GLM tests and curves of many groups (years) in one pass each.

A report of every year needs, for each year, what :mod:`features`, :mod:`stats` and :mod:`evaluate` compute for one
frame. Here the year is a grouping key instead of a loop on the driver: the number of jobs is the same for one
year and for a hundred.

* :func:`fit_groups` -- moments of the numeric columns by one grouped aggregate; category ranks by one count of
  ``(group, column, value)`` and a window over the distinct values.
* :func:`group_frame` -- imputed and standardized inputs of every row; the statistics of a group are one row,
  joined by broadcast (as many rows as groups).
* :func:`group_moments` -- count, sums and cross products of the inputs and the label: one row a group. Everything
  after it is arithmetic on those rows, in column expressions (:mod:`loanlens.functions.linalg`).
* :func:`group_correlations`, :func:`group_hypotheses` -- from the moments alone.
* :func:`group_curves`, :func:`group_metrics`, :func:`group_confusion` -- from a histogram keyed by group. Scores are dealt
  into ranges at the group's own approximate quantiles, so a group with most rows is many tasks.

A column without a value in a group is left out of that group's inputs (it is constant 0 in the vector, and has no row
in the tables).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import readable_label_py
from loanlens.functions.linalg import cholesky, dot, gram_of_lower, let, lower_inverse, matrix_times
from loanlens.functions.special import student_t_two_sided
from loanlens.operators.evaluate import usable
from loanlens.operators.features import DEFAULT_MAX_INLINE, INDEX_SALTS
from loanlens.operators.stats import INTERCEPT_LABEL
from loanlens.schemas import CATEGORICAL_FEATURES, CONFUSION_THRESHOLD, GLM_REG_PARAM, MODEL_FEATURES, NUMERIC_FEATURES
from loanlens.session import checkpointed

RANGES = 64  # score ranges a group
FLAT = 1e-12  # population variance up to which a standardized input is constant


@dataclass
class GroupStats:
    """Fitted statistics of every group; ``key`` may be null."""

    key: str
    features: list[str]
    rows: DataFrame  # key, mean, std (arrays in feature order; null: no value in the group), ranks (by column and value), last (rank, by column)
    large: dict[str, DataFrame]  # key, value, idx of the columns with many values


def _value(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _present(col: str) -> Column:
    c = F.col(col).cast("double")
    return F.when(~F.isnan(c), c)


def category_ranks(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``key, column, value, n, idx``: 0-based rank of each value in its group, most frequent first, ties alphabetical."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), _value(c).alias("value")) for c in cols)))
    counts = df.select(key, pairs.alias("_p")).select(key, "_p.*").groupBy(key, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy(key, "column").orderBy(F.desc("n"), "value")
    return counts.withColumn("idx", (F.row_number().over(ranked) - 1).cast("int"))


def fit_groups(
    df: DataFrame, key: str, numeric: list[str] | None = None, categorical: list[str] | None = None, max_inline: int = DEFAULT_MAX_INLINE
) -> GroupStats:
    """Statistics of every group of ``df`` (numeric columns cast to double)."""
    numeric, categorical = numeric or NUMERIC_FEATURES, categorical or CATEGORICAL_FEATURES
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(numeric):
        v = _present(c)
        aggregates += [F.count(v).alias(f"_k{i}"), F.avg(v).alias(f"_m{i}"), F.var_pop(v).alias(f"_v{i}")]
    number = df.groupBy(key).agg(*aggregates)
    # sample deviation of the column after missing cells took the mean
    spread = lambda total, count, var: F.when(F.col(total) > 1, F.sqrt(F.col(var) * F.col(count) / (F.col(total) - 1))).otherwise(0.0)
    number = number.select(
        key,
        F.array(*(F.col(f"_m{i}") for i in range(len(numeric)))).alias("_mean"),
        F.array(*(F.when(F.col(f"_k{i}") > 0, spread("_n", f"_k{i}", f"_v{i}")) for i in range(len(numeric)))).alias("_std"),
    )
    ranks = checkpointed(category_ranks(df, key, categorical))
    # the index column's moments in whole numbers
    dec = "decimal(38,0)"
    n, idx = F.col("n").cast(dec), F.col("idx").cast(dec)
    sums = ranks.groupBy(key, "column").agg(F.sum(n).alias("n"), F.sum(idx * n).alias("s1"), F.sum(idx * idx * n).alias("s2"), F.max("idx").alias("last"))
    total = F.col("n").cast("double")
    within = (F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")).cast("double") / total  # sum of squared deviations
    moments = sums.select(
        key, "column", "last", (F.col("s1").cast("double") / total).alias("mean"), F.when(total > 1, F.sqrt(within / (total - 1))).otherwise(0.0).alias("std")
    )
    moments = checkpointed(moments)
    widest = {r["column"]: r["last"] for r in moments.groupBy("column").agg(F.max("last").alias("last")).collect()}  # one row a column
    many = [c for c in categorical if widest.get(c, 0) >= max_inline]
    by_column = lambda name: F.map_from_entries(F.collect_list(F.struct("column", name)))
    indexed = moments.groupBy(key).agg(by_column("mean").alias("_cm"), by_column("std").alias("_cs"), by_column("last").alias("last"))
    in_order = lambda m: F.array(*(F.try_element_at(m, F.lit(c)) for c in categorical))
    few = ranks.where(~F.col("column").isin(many)) if many else ranks
    maps = few.groupBy(key, "column").agg(F.map_from_entries(F.collect_list(F.struct("value", "idx"))).alias("_of")).groupBy(key)
    maps = maps.agg(F.map_from_entries(F.collect_list(F.struct("column", "_of"))).alias("ranks"))
    same = lambda a, b: a[key].eqNullSafe(b[key])
    rows = number.join(indexed, same(number, indexed)).drop(indexed[key])
    rows = rows.join(maps, same(rows, maps), "left").drop(maps[key])
    rows = rows.select(key, F.concat("_mean", in_order(F.col("_cm"))).alias("mean"), F.concat("_std", in_order(F.col("_cs"))).alias("std"), "ranks", "last")
    large = {c: ranks.where(F.col("column") == c).select(F.col(key).alias("_key"), "value", "idx") for c in many}
    return GroupStats(key, [*numeric, *(f"{c}_index" for c in categorical)], checkpointed(rows), large)


def _join_rank(df: DataFrame, ranks: DataFrame, key: str, col: str) -> DataFrame:
    """Rank of a column with many values by an equi-join; rows of a frequent value spread over salts."""
    salt = F.pmod(F.xxhash64(*(F.col(c) for c in df.columns)), F.lit(INDEX_SALTS)).cast("int")
    keyed = df.withColumns({"_v": _value(col), "_salt": salt})
    spread = ranks.withColumnRenamed("value", "_value").withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(INDEX_SALTS - 1))))
    on = keyed[key].eqNullSafe(spread["_key"]) & (keyed["_v"] == spread["_value"]) & (keyed["_salt"] == spread["_at"])
    return keyed.join(spread, on, "left").select(*df.columns, F.col("idx").cast("double").alias(f"_rank_{col}"))


def group_frame(df: DataFrame, stats: GroupStats, keep: list[str], label: str = "is_foreclosed") -> DataFrame:
    """``key, *keep, label, out, z, features``: imputed and standardized inputs (arrays in feature order), and the latter as a vector.

    A value that the fit has not seen ranks after all known ones.
    """
    key, categorical = stats.key, [f.removesuffix("_index") for f in stats.features if f.endswith("_index")]
    numeric = stats.features[: len(stats.features) - len(categorical)]
    fit = stats.rows.select(F.col(key).alias("_key"), "mean", "std", "ranks", "last")
    for c, ranks in stats.large.items():
        df = _join_rank(df, ranks, key, c)
    # one row a group
    joined = df.join(F.broadcast(fit), df[key].eqNullSafe(fit["_key"])).drop("_key")

    def rank(c: str) -> Column:
        found = F.col(f"_rank_{c}") if c in stats.large else F.try_element_at(F.try_element_at("ranks", F.lit(c)), _value(c))
        return F.coalesce(found, F.try_element_at("last", F.lit(c)) + 1).cast("double")

    raw = [_present(c) for c in numeric] + [rank(c) for c in categorical]
    mean = [F.get("mean", F.lit(i)) for i in range(len(raw))]
    out = F.array(*(F.coalesce(x, m, F.lit(0.0)) for x, m in zip(raw, mean, strict=True)))
    z = F.zip_with(F.zip_with("out", "mean", lambda x, m: x - m), "std", lambda d, s: F.when(s > 0, d / s).otherwise(0.0))
    rows = joined.select(F.col(key), *keep, F.col(label).cast("int").alias("label"), out.alias("out"), "mean", "std")
    rows = rows.select(key, *keep, "label", "out", z.alias("z"))
    return rows.withColumn("features", array_to_vector("z"))


def group_moments(frame: DataFrame, stats: GroupStats) -> DataFrame:
    """``key, n, used, mean, cov, y, cxy, vy``: population moments of the standardized inputs and the label, one row a group.

    ``used`` marks the inputs with a value in the group. One grouped aggregate of all sums (partial, then final).
    """
    key, p = stats.key, len(stats.features)
    z = [F.get("z", F.lit(i)) for i in range(p)]
    y = F.col("label").cast("double")
    aggregates = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("_y")]
    aggregates += [F.sum(z[i]).alias(f"_s{i}") for i in range(p)] + [F.sum(z[i] * y).alias(f"_c{i}") for i in range(p)]
    aggregates += [F.sum(z[i] * z[j]).alias(f"_x{i}_{j}") for i in range(p) for j in range(i + 1)]
    one = frame.groupBy(key).agg(*aggregates)
    n = F.col("n")
    mean = [F.col(f"_s{i}") / n for i in range(p)]
    cov = F.array(*(F.array(*(F.col(f"_x{max(i, j)}_{min(i, j)}") / n - mean[i] * mean[j] for j in range(p))) for i in range(p)))
    rows = one.select(
        key, "n", F.array(*mean).alias("mean"), cov.alias("cov"), (F.col("_y") / n).alias("y"),
        F.array(*(F.col(f"_c{i}") / n - mean[i] * F.col("_y") / n for i in range(p))).alias("cxy"),
    )
    used = stats.rows.select(F.col(key).alias("_key"), F.transform("std", lambda s: s.isNotNull()).alias("used"))
    joined = rows.join(F.broadcast(used), rows[key].eqNullSafe(used["_key"])).drop("_key")
    return joined.withColumn("vy", F.col("y") * (1 - F.col("y")))


def group_correlations(moments: DataFrame, stats: GroupStats) -> DataFrame:
    """``key, feature_a, feature_b, r``: the strictly lower triangle of each group; ``r`` is null when either is constant."""
    label = F.array(*(F.lit(readable_label_py(f"out_{f}")) for f in stats.features))
    rows = moments.select(stats.key, "used", "cov", F.posexplode("cov").alias("_i", "_row"))
    cells = rows.select(stats.key, "used", "cov", "_i", F.posexplode("_row").alias("_j", "_x")).where("_j < _i")
    var = lambda i: F.get(F.get("cov", F.col(i)), F.col(i))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_x") / F.sqrt(var("_i") * var("_j"))))
    return cells.where(F.get("used", F.col("_i")) & F.get("used", F.col("_j"))).select(
        stats.key, F.get(label, F.col("_i")).alias("feature_a"), F.get(label, F.col("_j")).alias("feature_b"),
        F.when((var("_i") > FLAT) & (var("_j") > FLAT), r).alias("r"),
    )


def group_hypotheses(moments: DataFrame, stats: GroupStats, reg: float = GLM_REG_PARAM) -> DataFrame:
    """Ridge Gaussian GLM of each group with t tests: ``key, position, feature, coefficient, std_error, t, p, p_bonferroni,
    p_bonferroni_capped``; the intercept last.

    The normal equations over inputs scaled to unit deviation, ``(R + reg / sd(label) I) b = r``, are solved by the
    Cholesky triangle of the matrix; its inverse gives the standard errors. A constant input has coefficient 0 and an
    infinite error. In a group with one label class the coefficients are 0 and nothing is tested (null).
    """
    key, p = stats.key, len(stats.features)
    live = F.transform("cov", lambda row, i: F.get(row, i) > FLAT)
    base = moments.withColumns({"_live": live, "_sd": F.transform("cov", lambda row, i: F.sqrt(F.greatest(F.get(row, i), F.lit(FLAT))))})
    penalty = F.lit(reg) / F.sqrt("vy")
    cell = lambda row, i: F.transform(
        row,
        lambda x, j: F.when(i == j, F.when(F.get("_live", i), 1.0 + penalty).otherwise(1.0))
        .when(F.get("_live", i) & F.get("_live", j), x / (F.get("_sd", i) * F.get("_sd", j)))
        .otherwise(0.0),
    )
    right = F.transform("cxy", lambda c, i: F.when(F.get("_live", i), c / F.get("_sd", i)).otherwise(0.0))
    tested = base.where("vy > 0").withColumns({"_a": F.transform("cov", cell), "_b": right})
    tested = tested.withColumn("_inv", gram_of_lower(lower_inverse(cholesky(F.col("_a")))))
    tested = tested.withColumn("_beta", F.zip_with(matrix_times(F.col("_inv"), F.col("_b")), "_sd", lambda b, s: b / s))
    fitted = F.lit(2.0) * dot(F.col("_beta"), F.col("cxy")) - dot(F.col("_beta"), matrix_times(F.col("cov"), F.col("_beta")))
    count = F.size(F.filter("used", lambda u: u))
    df = F.col("n") - count - 1
    tested = tested.withColumns({"_count": count, "_df": df, "_disp": F.col("n") * (F.col("vy") - fitted) / df})
    error = let(
        F.col("_disp") / F.col("n"),
        lambda d: F.transform("_inv", lambda row, i: F.when(F.get("_live", i), F.sqrt(d * F.get(row, i)) / F.get("_sd", i)).otherwise(float("inf"))),
    )
    intercept = F.col("y") - dot(F.col("mean"), F.col("_beta"))
    tested = tested.select(
        key, "used", "_count", "_df", F.concat("_beta", F.array(intercept)).alias("_coef"), F.concat(error, F.array(F.sqrt(F.col("_disp") / F.col("n")))).alias("_se")
    )
    none = F.lit(None).cast("double")
    single = base.where("vy <= 0").select(
        key, "used", F.size(F.filter("used", lambda u: u)).alias("_count"), none.alias("_df"),
        F.concat(F.array(*([F.lit(0.0)] * p)), F.array("y")).alias("_coef"), F.array(*([none] * (p + 1))).alias("_se"),
    )
    names = F.array(*(F.lit(readable_label_py(f"out_{f}")) for f in stats.features), F.lit(INTERCEPT_LABEL))
    rows = tested.unionByName(single).withColumn("_name", names)
    cell = lambda coef, error, name, i: F.struct(
        F.size(F.filter(F.slice("used", 1, i), lambda u: u)).alias("position"), name.alias("feature"), F.get(coef, i).alias("coefficient"),
        F.get(error, i).alias("std_error"), ((i == p) | F.get("used", i)).alias("_used"),
    )
    cells = let(F.col("_coef"), lambda coef: let(F.col("_se"), lambda error: F.transform("_name", lambda name, i: cell(coef, error, name, i))))
    out = rows.select(key, "_count", "_df", F.inline(cells)).where("_used")
    t = F.when(F.col("std_error") == float("inf"), 0.0).otherwise(F.col("coefficient") / F.col("std_error"))
    out = out.withColumn("t", t).withColumn("p", student_t_two_sided(F.col("t"), F.col("_df")))
    raw = F.col("p") * F.col("_count")
    return out.select(
        key, "position", "feature", "coefficient", "std_error", "t", "p", raw.alias("p_bonferroni"), F.least(raw, F.lit(1.0)).alias("p_bonferroni_capped")
    )


# ---- evaluation by group -----------------------------------------------------------


def group_histogram(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, score, pos, neg``: label counts of every distinct score of each group."""
    rows = usable(predictions, keep=keys)
    return rows.groupBy(*keys, "score").agg(F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"_{k}"])
    return on


def group_totals(histogram: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """``*keys, score, pos, neg, tp, fp, positives, negatives``: running totals from the highest score of each group down.

    Windows run within a score range of a group; a range's offset is a window over the totals of the ranges
    (at most ``ranges`` rows a group). Exact for any number of ranges.
    """
    named = [F.col(k).alias(f"_{k}") for k in keys]
    shares = [i / ranges for i in range(1, ranges)]
    cuts = histogram.groupBy(*keys).agg(F.percentile_approx("score", shares, 10 * ranges).alias("_cuts")).select(*named, "_cuts")
    # one row a group
    joined = histogram.join(F.broadcast(cuts), _same(histogram, cuts, keys)).drop(*(f"_{k}" for k in keys))
    dealt = joined.withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col("score")))).drop("_cuts")
    by_range = dealt.groupBy(*keys, "_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    above = Window.partitionBy(*keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = by_range.select(
        *named, F.col("_range").alias("_r"),
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_fp"),
        F.sum("_pos").over(whole).alias("positives"), F.sum("_neg").over(whole).alias("negatives"),
    )
    down = Window.partitionBy(*keys, "_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = dealt.withColumns({"_in_tp": F.sum("pos").over(down), "_in_fp": F.sum("neg").over(down)})
    out = summed.join(F.broadcast(offsets), _same(summed, offsets, keys) & (summed["_range"] == offsets["_r"]))
    return out.select(
        *keys, "score", "pos", "neg", (F.col("_in_tp") + F.col("_tp")).alias("tp"), (F.col("_in_fp") + F.col("_fp")).alias("fp"), "positives", "negatives"
    )


def _share(a: Column, b: Column) -> Column:
    return F.try_divide(a, b).cast("double")


def group_curves(totals: DataFrame, keys: list[str]) -> DataFrame:
    """ROC and PR points of every group, one a distinct score: ``*keys, threshold, tp, fp, tpr, fpr, precision, recall``."""
    tp, fp = F.col("tp"), F.col("fp")
    tpr = _share(tp, F.col("positives"))
    return totals.select(
        *keys, F.col("score").alias("threshold"), tp, fp, tpr.alias("tpr"), _share(fp, F.col("negatives")).alias("fpr"),
        _share(tp, tp + fp).alias("precision"), tpr.alias("recall"),
    )


def group_metrics(totals: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, metric, value``: areas under the whole ROC and PR curves (trapezoids, no binning), the rank-sum AUC, rows.

    The point before a curve point follows from the point's own counts, so the areas are plain sums. The PR curve starts at recall 0
    with the precision of its first point, as Spark's evaluator has it.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    p, n = F.max("positives").cast("double"), F.max("negatives").cast("double")
    roc = F.sum(neg * (tp + tp - pos) / 2)
    here = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), here)
    pr = F.sum(pos * (here + before) / 2)
    # wins of positives over the negatives with lower scores, ties half
    wins = F.sum(pos * (F.col("negatives").cast("double") - fp + neg / 2))
    one = totals.groupBy(*keys).agg(
        F.try_divide(roc, p * n).alias("areaUnderROC"), F.try_divide(pr, p).alias("areaUnderPR"), F.try_divide(wins, p * n).alias("exactAUC"),
        (p + n).alias("testRows"),
    )
    metrics = ("areaUnderROC", "areaUnderPR", "exactAUC", "testRows")
    return one.select(*keys, F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics))))


def group_confusion(predictions: DataFrame, keys: list[str], threshold: float = CONFUSION_THRESHOLD) -> DataFrame:
    """``*keys, label, predicted, n``: always four rows a group; predicted is 1 when the score exceeds the threshold."""
    predicted = (F.col("score") > F.lit(threshold)).cast("int")
    cells = [(y, p) for y in (0, 1) for p in (0, 1)]
    one = usable(predictions, keep=keys).groupBy(*keys).agg(*(F.count_if((F.col("label") == y) & (predicted == p)).alias(f"_{y}{p}") for y, p in cells))
    return one.select(*keys, F.inline(F.array(*(F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(f"_{y}{p}").alias("n")) for y, p in cells))))
