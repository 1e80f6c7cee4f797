"""Correlation matrix, GLM hypothesis tests, multiple-testing correction."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions import readable_label_py
from loanlens.schemas import GLM_MAX_ITER, GLM_REG_PARAM
from loanlens.session import local_rows

INTERCEPT_LABEL = "Intercept"


CORRELATION_SCHEMA = "feature_a string, feature_b string, r double"


def correlation_matrix(df: DataFrame, cols: list[str], vector_col: str | None = None):
    """Pearson matrix of ``cols`` (a p x p numpy array; NaN where a column is constant).

    ``pyspark.ml.stat.Correlation`` tree-aggregates the column means and then
    the packed upper triangle of the centred cross products with BLAS; only
    the p x p result reaches the driver. Inputs must be complete (imputed): a missing value is an error.
    """
    if vector_col is None:
        vector_col = "_corr_vec"
        df = VectorAssembler(inputCols=cols, outputCol=vector_col, handleInvalid="error").transform(df.select(*cols))
    return Correlation.corr(df.select(vector_col), vector_col, "pearson").head()[0].toArray()


def correlation_long(
    df: DataFrame,
    cols: list[str],
    readable: bool = True,
    lower_only: bool = True,
    means: dict[str, float] | None = None,
    method: str = "ml",
    vector_col: str | None = None,
) -> DataFrame:
    """Pearson correlation of every column pair as rows ``(feature_a, feature_b, r)``.

    ``method="ml"`` (default) uses :func:`correlation_matrix` and returns the
    bounded long table (p(p-1)/2 rows for the lower triangle). ``vector_col``
    may name an already assembled vector of ``cols`` in that order.
    ``method="sql"`` is the same statistic as one DataFrame aggregate, see
    :func:`correlation_long_sql`. ``r`` is null when either column is constant.
    ``lower_only`` keeps the strictly lower triangle (``a`` after ``b`` in
    ``cols`` order), the part the heatmap shows.
    """
    if method == "sql":
        return correlation_long_sql(df, cols, readable, lower_only, means)
    m = correlation_matrix(df, cols, vector_col)
    label = readable_label_py if readable else (lambda s: s)
    p = len(cols)
    # Spark puts 1.0 on the whole diagonal; a constant column shows as a row of NaN elsewhere.
    constant = [p > 1 and all(math.isnan(m[i, j]) for j in range(p) if j != i) for i in range(p)]
    rows = []
    for i in range(p):
        for j in range(p):
            if (j < i) if lower_only else True:
                r = float(m[i, j])
                if i == j and constant[i]:
                    r = float("nan")
                r = None if math.isnan(r) else max(-1.0, min(1.0, r))
                rows.append((label(cols[i]), label(cols[j]), r))
    return local_rows(df.sparkSession, rows, CORRELATION_SCHEMA)


def correlation_long_sql(
    df: DataFrame,
    cols: list[str],
    readable: bool = True,
    lower_only: bool = True,
    means: dict[str, float] | None = None,
) -> DataFrame:
    """Pearson correlations as one DataFrame aggregate (same output as :func:`correlation_long`).

    One global aggregate (partial per task, one output row) sums the
    products of mean-centred values for every pair, plus each column's
    min and max; the row is then unpivoted in Spark. Centring by the mean
    keeps the sums well conditioned. Means come from ``means`` when the
    caller already has them (e.g. from the imputation fit), otherwise from
    one extra aggregate. ``r`` is null when either column is constant.
    Inputs must be complete (imputed): a missing value is an error, as in the other form.
    ``lower_only`` keeps the strictly lower triangle (``a`` after ``b`` in
    ``cols`` order), the part the heatmap shows.
    """
    x = [F.col(c).cast("double") for c in cols]
    if means is None or any(c not in means for c in cols):
        row = df.agg(*[F.avg(x[i]).alias(f"_m{i}") for i in range(len(cols))]).first()
        mu = [row[f"_m{i}"] for i in range(len(cols))]
    else:
        mu = [means[c] for c in cols]
    centred = df.select(
        *[(x[i] - F.lit(mu[i] if mu[i] is not None else 0.0)).alias(f"_x{i}") for i in range(len(cols))]
    )
    xc = [F.col(f"_x{i}") for i in range(len(cols))]
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if (j < i if lower_only else True)]
    needed = sorted({(i, j) if i > j else (j, i) for i, j in pairs if i != j})
    aggs = []
    for i in range(len(cols)):
        aggs += [
            F.sum(xc[i] * xc[i]).alias(f"_v{i}"),
            F.min(xc[i]).alias(f"_lo{i}"),
            F.max(xc[i]).alias(f"_hi{i}"),
        ]
    aggs += [F.sum(xc[i] * xc[j]).alias(f"_c{i}_{j}") for i, j in needed]
    missing = F.sum(sum((F.when(c.isNull() | F.isnan(c), 1).otherwise(0) for c in xc), F.lit(0)))
    one_row = centred.agg(*aggs, missing.alias("_missing"))
    incomplete = F.raise_error(F.lit("correlation inputs have missing values")).cast("boolean")
    one_row = one_row.where(F.when(F.col("_missing") > 0, incomplete).otherwise(F.lit(True)))

    def varying(i: int):
        return F.col(f"_hi{i}") > F.col(f"_lo{i}")

    def r_expr(i: int, j: int):
        if i == j:
            return F.when(varying(i), F.lit(1.0))
        a, b = (i, j) if i > j else (j, i)
        r = F.col(f"_c{a}_{b}") / F.sqrt(F.col(f"_v{a}") * F.col(f"_v{b}"))
        return F.when(varying(a) & varying(b), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))

    label = readable_label_py if readable else (lambda s: s)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(label(cols[i])).alias("feature_a"),
                    F.lit(label(cols[j])).alias("feature_b"),
                    r_expr(i, j).alias("r"),
                )
                for i, j in pairs
            ]
        )
    )
    return one_row.select(rows.alias("p")).select("p.*")


def glm_moments(df: DataFrame, cols: list[str], label_col: str = "is_foreclosed", prefix: str = "z_") -> DataFrame:
    """The data-sized part of the Gaussian fit as rows ``(moment, a, b, value)``.

    ``n``, the mean of each input and of the label, and the products ``x'x`` (each pair once) and ``x'y``, in one
    aggregate; a Gaussian / identity fit is a function of these alone.
    """
    x = {c: F.col(f"{prefix}{c}").cast("double") for c in cols}
    y = F.col(label_col).cast("double")
    cells = [("n", "", "", F.count(F.lit(1)).cast("double"))]
    cells += [("mean", c, "", F.avg(x[c])) for c in cols] + [("mean", label_col, "", F.avg(y))]
    cells += [("xx", a, b, F.sum(x[a] * x[b])) for i, a in enumerate(cols) for b in cols[: i + 1]]
    cells += [("xy", c, label_col, F.sum(x[c] * y)) for c in cols]
    one = df.agg(*(e.alias(f"_{i}") for i, (_, _, _, e) in enumerate(cells)))
    rows = [
        F.struct(F.lit(m).alias("moment"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("value")) for i, (m, a, b, _) in enumerate(cells)
    ]
    return one.select(F.inline(F.array(*rows)))


def fit_glm(df: DataFrame, features_col: str = "scaledFeatures", label_col: str = "is_foreclosed"):
    """Gaussian / identity GLM with L2 regularization (the hypothesis-test model)."""
    glm = GeneralizedLinearRegression(
        family="gaussian",
        link="identity",
        maxIter=GLM_MAX_ITER,
        regParam=GLM_REG_PARAM,
        featuresCol=features_col,
        labelCol=label_col,
    )
    return glm.fit(df.select(features_col, label_col))


def bonferroni(df: DataFrame, m: int, p_col: str = "p") -> DataFrame:
    """Add ``p_bonferroni = p * m`` (uncapped, as reported) and ``p_bonferroni_capped = min(p*m, 1)``."""
    adj = F.col(p_col) * F.lit(float(m))
    return df.withColumn("p_bonferroni", adj).withColumn("p_bonferroni_capped", F.least(adj, F.lit(1.0)))


def hypothesis_table(
    spark: SparkSession,
    df: DataFrame,
    feature_names: list[str],
    features_col: str = "scaledFeatures",
    label_col: str = "is_foreclosed",
) -> DataFrame:
    """Coefficient, std error, t and p per feature (and the intercept), Bonferroni-corrected.

    The fit is distributed (normal equations aggregated over partitions);
    the result has one row per feature. The number of hypotheses is the
    number of features; the intercept row is corrected with the same factor.
    """
    model = fit_glm(df, features_col, label_col)
    summary = model.summary
    coefs = list(model.coefficients.toArray()) + [model.intercept]
    ses = list(summary.coefficientStandardErrors)
    ts = list(summary.tValues)
    ps = list(summary.pValues)
    names = [readable_label_py("out_" + f) for f in feature_names] + [INTERCEPT_LABEL]
    rows = [
        (i, names[i], float(coefs[i]), float(ses[i]), float(ts[i]), float(ps[i])) for i in range(len(names))
    ]
    table = local_rows(spark, rows, "position int, feature string, coefficient double, std_error double, t double, p double")
    return bonferroni(table, len(feature_names))
