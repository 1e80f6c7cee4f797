"""Ridge logistic regression of many groups at once by Newton's method.

Each round is one grouped aggregate of the gradient and the Hessian over all rows, with the coefficients of the round before
(one row a group) joined by broadcast; the step is solved on the aggregated row in column expressions. So the number of
jobs is the number of rounds, whatever the number of groups, and a group's fit depends on its rows alone, not on how they are laid out.

The objective is that of ``pyspark.ml``: mean log loss plus ``reg / 2`` times the squared coefficients, the intercept
free. Newton converges to the minimum (tests hold both equal to six digits), so the number of rounds is fixed.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import readable_label_py
from loanlens.functions.linalg import cholesky, dot, gram_of_lower, let, lower_inverse, matrix_times
from loanlens.operators.stats import INTERCEPT_LABEL
from loanlens.session import checkpointed

ROUNDS = 8
REG = 1e-3
FLAT = 1e-12  # mean curvature up to which an input is constant


def _probability(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def fit_logistic_groups(frame: DataFrame, key: str, p: int, reg: float = REG, rounds: int = ROUNDS) -> DataFrame:
    """``key, n, coefficients`` (the ``p`` inputs, then the intercept) of every group of ``frame(key, z, label)``.

    An input that is constant in a group has coefficient 0. A group without rows has no result; with one label class
    the intercept grows with the rounds, as the minimum lies at infinity.
    """
    size = p + 1
    coefficients = checkpointed(frame.select(key).distinct().select(key, F.array(*([F.lit(0.0)] * size)).alias("coefficients")))
    # the expressions of a round are the same in all rounds; numbers stand in columns of their own, a missing one adds nothing
    x = [F.col(f"_x{i}") for i in range(p)] + [F.lit(1.0)]
    number = lambda array, i: F.coalesce(F.get(array, F.lit(i)), F.lit(0.0))
    logit = functools.reduce(lambda s, i: s + x[i] * F.col(f"_b{i}"), range(size), F.lit(0.0))
    lines = [F.sum(F.col("_wv") * v).alias(f"_h{i}") for i, v in enumerate(x)] + [F.sum(F.col("_rest") * F.col("_v")).alias("_g"), F.count(F.lit(1)).alias("_n")]
    line = F.struct("_i", F.array(*(f"_h{i}" for i in range(size))).alias("_h"), "_g", "_n")
    triangle = F.flatten(F.transform("_lines", lambda r: F.slice(r["_h"], F.lit(1), r["_i"] + 1)))
    sums = F.concat(triangle, F.transform("_lines", lambda r: r["_g"]), F.array(F.get("_lines", F.lit(0))["_n"].cast("double")))
    cells = size * (size + 1) // 2
    places = F.sequence(F.lit(0), F.lit(size - 1))
    penalty = lambda i: F.when(i < p, F.lit(reg)).otherwise(0.0)

    def step(h: Column, g: Column, b: Column, live: Column) -> Column:
        """The Newton step from the mean Hessian (a triangle, row by row) and the mean gradient."""
        at = lambda i, j: F.get(h, (F.greatest(i, j) * (F.greatest(i, j) + 1) / 2).cast("int") + F.least(i, j))
        cell = lambda i, j: (
            F.when(i == j, F.when(F.get(live, i), at(i, i) + penalty(i)).otherwise(1.0)).when(F.get(live, i) & F.get(live, j), at(i, j)).otherwise(0.0)
        )
        matrix = F.transform(places, lambda i: F.transform(places, lambda j: cell(i, j)))
        right = F.transform(g, lambda v, i: F.when(F.get(live, i), v - penalty(i) * F.get(b, i)).otherwise(0.0))
        return F.zip_with(b, matrix_times(gram_of_lower(lower_inverse(cholesky(matrix))), right), lambda x, d: x + d)

    def solved(sums: Column, b: Column) -> Column:
        means = let(F.element_at(sums, -1), lambda n: F.transform(sums, lambda v: v / n))
        diagonal = lambda h: F.transform(places, lambda i: F.get(h, (i * (i + 3) / 2).cast("int")) > FLAT)
        parts = lambda m: let(
            F.slice(m, 1, cells), lambda h: let(F.slice(m, cells + 1, size), lambda g: let(diagonal(h), lambda live: step(h, g, b, live)))
        )
        return let(means, parts)

    # bound once: what stands inside a lambda is computed for every element
    update = let(F.col("_s"), lambda sums: let(F.col("_b"), lambda b: solved(sums, b)))
    for _ in range(rounds):
        last = coefficients.select(F.col(key).alias("_key"), F.col("coefficients").alias("_b"))
        # one row a group
        apart = last.select("_key", *(number("_b", i).alias(f"_b{i}") for i in range(size)))
        rows = frame.select(key, "label", "z", *(number("z", i).alias(f"_x{i}") for i in range(p))).join(F.broadcast(apart), F.col(key).eqNullSafe(F.col("_key")))
        rows = rows.select(key, "label", "z", *x[:p], _probability(logit).alias("_p"))
        rows = rows.select(key, "z", *x[:p], (F.col("_p") * (1 - F.col("_p"))).alias("_w"), (F.col("label") - F.col("_p")).alias("_rest"))
        # a line of the Hessian for each input: few sums at a time, which generated code adds up in each task before they are sent
        rows = rows.select(key, *x[:p], "_w", "_rest", F.posexplode(F.concat("z", F.array(F.lit(1.0)))).alias("_i", "_u"))
        rows = rows.select(key, "_i", *x[:p], "_w", "_rest", F.coalesce("_u", F.lit(0.0)).alias("_v"))
        rows = rows.select(key, "_i", *x[:p], "_rest", "_v", (F.col("_w") * F.col("_v")).alias("_wv"))
        summed = rows.groupBy(key, "_i").agg(*lines).groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("_lines")).select(key, sums.alias("_s"))
        one = summed.join(F.broadcast(last), F.col(key).eqNullSafe(F.col("_key")))
        coefficients = checkpointed(one.select(key, F.element_at("_s", -1).cast("bigint").alias("n"), update.alias("coefficients")))
    return coefficients


def coefficient_table(fitted: DataFrame, key: str, features: list[str]) -> DataFrame:
    """``key, position, feature, coefficient``, the intercept last."""
    names = F.array(*(F.lit(readable_label_py(f"out_{f}")) for f in features), F.lit(INTERCEPT_LABEL))
    rows = fitted.select(key, F.posexplode("coefficients").alias("position", "coefficient"))
    return rows.select(key, "position", F.get(names, F.col("position")).alias("feature"), "coefficient")


def score_groups(frame: DataFrame, fitted: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """``key, *keep, label, score``: the probability of label 1 of every row, by its group's coefficients."""
    by = fitted.select(F.col(key).alias("_key"), F.col("coefficients").alias("_b"))
    rows = frame.join(F.broadcast(by), F.col(key).eqNullSafe(F.col("_key")))
    return rows.select(key, *keep, "label", _probability(dot(F.concat("z", F.array(F.lit(1.0))), F.col("_b"))).alias("score"))
