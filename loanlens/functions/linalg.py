"""Small dense matrices as column expressions: a matrix is ``array<array<double>>``, one row a matrix.

For matrices of statistics (a few dozen rows, one matrix a group), not of data. Everything is built from Spark's
higher-order functions, so groups are solved where their row is, and nothing is fetched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERS = "array<double>"
MATRIX = "array<array<double>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it: an expression that stands inside a
    lambda is otherwise computed anew for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    """Sum of the products of two arrays; a longer one is cut to the other's size."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def indexes(n: Column) -> Column:
    """``0 .. n - 1``; empty for 0."""
    return F.filter(F.sequence(F.lit(-1), n.cast("int") - 1), lambda i: i >= 0)


def matrix_times(m: Column, v: Column) -> Column:
    return let(v, lambda v: F.transform(m, lambda row: dot(row, v)))


def cholesky(a: Column) -> Column:
    """Lower triangle ``L`` with ``L L' = a`` for a symmetric positive definite ``a``; row ``i`` has ``i + 1`` numbers."""

    def next_row(done: Column, given: Column, i: Column) -> Column:
        def next_cell(row: Column, j: Column) -> Column:
            other = F.get(done, j)
            rest = F.get(given, j) - dot(row, F.coalesce(other, row))
            return F.concat(row, F.array(F.when(j < i, rest / F.get(other, j)).otherwise(F.sqrt(rest))))

        row = F.aggregate(F.sequence(F.lit(0), i), F.array().cast(NUMBERS), next_cell)
        return F.concat(done, F.array(row))

    def rows(a: Column) -> Column:
        step = lambda done, i: let(F.get(a, i), lambda given: next_row(done, given, i))
        return F.aggregate(indexes(F.size(a)), F.array().cast(MATRIX), step)

    return let(a, rows)


def lower_inverse(lower: Column) -> Column:
    """Inverse of a lower triangle as :func:`cholesky` gives it, in the same form."""

    def next_row(done: Column, given: Column, i: Column) -> Column:
        def cell(j: Column) -> Column:
            # column j of the rows done so far, from row j on
            column = F.transform(F.slice(done, j + 1, i - j), lambda r: F.get(r, j))
            rest = F.when(j == i, F.lit(1.0)).otherwise(-dot(column, F.slice(given, j + 1, i - j)))
            return rest / F.get(given, i)

        return F.concat(done, F.array(F.transform(F.sequence(F.lit(0), i), cell)))

    def rows(lower: Column) -> Column:
        step = lambda done, i: let(F.get(lower, i), lambda given: next_row(done, given, i))
        return F.aggregate(indexes(F.size(lower)), F.array().cast(MATRIX), step)

    return let(lower, rows)


def gram_of_lower(m: Column) -> Column:
    """``m' m`` of a lower triangle: the inverse of ``a`` when ``m`` is the inverse of its Cholesky triangle."""

    def cells(m: Column) -> Column:
        at = indexes(F.size(m))
        # row k adds the products of its own numbers, which end at column k
        cell = lambda i, j: F.aggregate(
            m, F.lit(0.0), lambda s, row: s + F.coalesce(F.get(row, i), F.lit(0.0)) * F.coalesce(F.get(row, j), F.lit(0.0))
        )
        return F.transform(at, lambda i: F.transform(at, lambda j: cell(i, j)))

    return let(m, cells)
