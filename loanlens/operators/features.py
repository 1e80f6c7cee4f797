"""Feature preparation: category indexing, mean imputation, standardization, assembly.

Each fit is one distributed aggregate whose result is small and bounded:

* category indexing stacks all categorical columns into ``(column, value)``
  pairs and counts them in a single grouped aggregate (partial + final),
  so eight columns cost one shuffle, not eight jobs. The counts are written
  once; each column is then decided on its own: up to ``max_inline`` values
  (1,000 by default) its ranking is a literal map, beyond that a ranked table
  which is joined with the hot values spread over salts.
* imputation and standardization statistics (non-missing count, mean,
  population variance per column) come from one global aggregate: one row,
  however large the input. The standard deviation of the mean-imputed
  column follows from those moments (imputed cells add nothing to the sum
  of squared deviations), so scaling needs no second pass.

The SQL-expression forms here are what the queries use; ``ml_feature_pipeline``
gives the equivalent ``pyspark.ml`` stages, and the tests hold the two equal.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.operators.cleaning import cast_numeric
from loanlens.operators.models import hash_split_column
from loanlens.schemas import CATEGORICAL_FEATURES, MODEL_FEATURES
from loanlens.session import checkpointed, local_rows

FREQUENCY_DESC = "frequencyDesc"
ALPHABET_ASC = "alphabetAsc"
DEFAULT_MAX_INLINE = 1_000  # map lookup scans the entries, so keep inlined maps small
INDEX_SALTS = 16


def _category_key(col: str):
    """Categorical value as text, as it is; null is the category ``''``."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, value, n)`` for every value of every column, in one grouped aggregate."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), _category_key(c).alias("value")) for c in cols])
    )
    return df.select(pairs.alias("kv")).select("kv.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def category_index_table(df: DataFrame, cols: list[str], order: str = FREQUENCY_DESC) -> DataFrame:
    """``(column, value, n, idx)``: 0-based index per column.

    ``frequencyDesc``: most frequent first, ties alphabetical (as ``StringIndexer``).
    ``alphabetAsc``: plain alphabetical order (label encoding).
    The window is partitioned by column and runs over the distinct values only
    (one task per column), which suits categorical columns, not ids.
    """
    counts = category_counts(df, cols)
    if order == FREQUENCY_DESC:
        ordering = [F.col("n").desc(), F.col("value").asc()]
    elif order == ALPHABET_ASC:
        ordering = [F.col("value").asc()]
    else:
        raise ValueError(f"unknown order {order!r}")
    w = Window.partitionBy("column").orderBy(*ordering)
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))


@dataclass
class IndexTable:
    """Fitted indices: a ranked list of ``(value, n)`` for a column with few values, a table
    ``(value, n, idx)`` on the checkpoint folder for one with many."""

    inline: dict[str, list[tuple[str, int]]]
    large: dict[str, DataFrame]

    def frame(self, spark) -> DataFrame:
        """All columns as ``(column, value, n, idx)``."""
        rows = [(c, v, n, i) for c, ranked in self.inline.items() for i, (v, n) in enumerate(ranked)]
        out = local_rows(spark, rows, "column string, value string, n bigint, idx int")
        for c, table in self.large.items():
            out = out.unionByName(table.select(F.lit(c).alias("column"), "value", "n", "idx"))
        return out


def _sort_keys(order: str) -> list:
    if order == FREQUENCY_DESC:
        return [F.col("n").desc(), F.col("value").asc()]
    if order == ALPHABET_ASC:
        return [F.col("value").asc()]
    raise ValueError(f"unknown order {order!r}")


def _driver_ranks(rows: list, order: str) -> list[tuple[str, int]]:
    """A bounded list of ``(value, n)`` rows in index order (same order as the window form)."""
    _sort_keys(order)
    key = (lambda r: (-r["n"], r["value"])) if order == FREQUENCY_DESC else (lambda r: r["value"])
    return [(r["value"], int(r["n"])) for r in sorted(rows, key=key)]


def _distributed_ranks(counts: DataFrame, order: str, partitions: int | None = None) -> DataFrame:
    """``idx`` of the ``(value, n)`` rows of one column without a window over all of them.

    Rows are range-partitioned in index order; each range partition numbers
    its own rows, and the number of rows before it comes from a table with
    one row per partition.
    """
    spark = counts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = _sort_keys(order)
    ranged = checkpointed(counts.repartitionByRange(n, *sort).withColumn("_pid", F.spark_partition_id()))
    offsets, acc = [], 0
    for pid, size in sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect()):
        offsets.append((pid, acc))
        acc += size
    w = Window.partitionBy("_pid").orderBy(*sort)
    before = F.broadcast(local_rows(spark, offsets, "_pid int, _before bigint"))
    return ranged.join(before, "_pid").select("value", "n", (F.row_number().over(w) - 1 + F.col("_before")).cast("int").alias("idx"))


def fit_index_table(
    df: DataFrame, cols: list[str], order: str = FREQUENCY_DESC, max_inline: int = DEFAULT_MAX_INLINE
) -> IndexTable:
    """Fit the index of each column: the same ranks as :func:`category_index_table`.

    One counting pass (partial + final aggregate), written once. Columns
    with at most ``max_inline`` values come back to the driver; the others
    are ranked by :func:`_distributed_ranks`, so no task holds a whole column.
    """
    _sort_keys(order)
    counts = checkpointed(category_counts(df, cols))
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}  # one row per column
    few = [c for c in cols if sizes.get(c, 0) <= max_inline]
    rows = counts.where(F.col("column").isin(few)).collect() if few else []
    inline = {c: _driver_ranks([r for r in rows if r["column"] == c], order) for c in few}
    large = {
        c: checkpointed(_distributed_ranks(counts.where(F.col("column") == c).select("value", "n"), order))
        for c in cols
        if c not in inline
    }
    return IndexTable(inline, large)


def apply_index_table(
    df: DataFrame, table: IndexTable, cols: list[str], suffix: str = "_index", dtype: str = "double"
) -> DataFrame:
    """Add ``<c><suffix>`` for each column from a fitted index.

    Values missing from the table (unseen categories) get the index equal to
    the number of known values, like ``handleInvalid='keep'``.
    """
    added = []
    for c in cols:
        if c in table.large:
            continue
        entries = table.inline.get(c, [])
        if entries:
            lookup = F.create_map(*[F.lit(x) for i, (value, _) in enumerate(entries) for x in (value, i)])
            found = F.try_element_at(lookup, _category_key(c))
        else:
            found = F.lit(None).cast("int")
        added.append(F.coalesce(found, F.lit(len(entries))).cast(dtype).alias(c + suffix))
    out = df.select("*", *added)
    for c in cols:
        if c in table.large:
            out = _join_index(out, table.large[c], c, suffix, dtype)
    return out.select(*df.columns, *(c + suffix for c in cols))


def _join_index(df: DataFrame, mapping: DataFrame, col: str, suffix: str, dtype: str) -> DataFrame:
    """Index of one column by an equi-join. A value may hold most rows: each row takes one of
    ``INDEX_SALTS`` salts, and the mapping is repeated for all of them."""
    known = mapping.count()
    salt = F.pmod(F.xxhash64(*[F.col(x) for x in df.columns]), F.lit(INDEX_SALTS)).cast("int")
    keyed = df.withColumns({"_v": _category_key(col), "_salt": salt})
    spread = mapping.select(
        F.col("value").alias("_value"), F.col("idx").alias("_idx"), F.explode(F.sequence(F.lit(0), F.lit(INDEX_SALTS - 1))).alias("_at")
    )
    joined = keyed.join(spread, (keyed["_v"] == spread["_value"]) & (keyed["_salt"] == spread["_at"]), "left")
    return joined.select(*df.columns, F.coalesce("_idx", F.lit(known)).cast(dtype).alias(col + suffix))


def string_index(
    df: DataFrame,
    cols: list[str] | None = None,
    suffix: str = "_index",
    order: str = FREQUENCY_DESC,
    dtype: str = "double",
    max_inline: int = DEFAULT_MAX_INLINE,
) -> DataFrame:
    """Index categorical columns by frequency (``<c>_index`` double); source columns kept."""
    cols = cols or CATEGORICAL_FEATURES
    return apply_index_table(df, fit_index_table(df, cols, order, max_inline), cols, suffix, dtype)


def label_encode(df: DataFrame, cols: list[str] | None = None, suffix: str = "_code") -> DataFrame:
    """Alphabetical label encoding (``<c>_code`` int, 0-based)."""
    return string_index(df, cols, suffix=suffix, order=ALPHABET_ASC, dtype="int")


# ---------------------------------------------------------------------------
# Moments, imputation, standardization
# ---------------------------------------------------------------------------


def _present(col: str):
    """Value with NaN treated as missing (null)."""
    c = F.col(col).cast("double")
    return F.when(~F.isnan(c), c)


@dataclass
class ColumnMoments:
    n: int  # all rows
    k: int  # rows with a value
    mean: float | None
    var_pop: float | None

    @property
    def imputed_std(self) -> float:
        """Sample std of the column after filling missing cells with the mean."""
        if self.k == 0 or self.n < 2:
            return 0.0
        m2 = (self.var_pop or 0.0) * self.k
        return math.sqrt(m2 / (self.n - 1))


@dataclass
class Moments:
    columns: dict[str, ColumnMoments] = field(default_factory=dict)

    def usable(self, cols: list[str]) -> list[str]:
        """Columns with at least one value (an all-missing column cannot be imputed)."""
        return [c for c in cols if c in self.columns and self.columns[c].k > 0]


def fit_moments(df: DataFrame, cols: list[str]) -> Moments:
    """Count, non-missing count, mean and population variance of each column in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        v = _present(c)
        aggs += [F.count(v).alias(f"_k{i}"), F.avg(v).alias(f"_m{i}"), F.var_pop(v).alias(f"_v{i}")]
    row = df.agg(*aggs).first()
    n = int(row["_n"])
    return Moments(
        {c: ColumnMoments(n, int(row[f"_k{i}"]), row[f"_m{i}"], row[f"_v{i}"]) for i, c in enumerate(cols)}
    )


def index_moments(table: IndexTable, cols: list[str], suffix: str = "_index") -> dict[str, ColumnMoments]:
    """Moments of the ``<c><suffix>`` columns computed from the fitted index alone.

    Every row has a category (null is ``''``), so for a column with
    values ``idx`` occurring ``n`` times: N = sum n, mean = sum(idx n) / N,
    population variance = (N sum(idx^2 n) - sum(idx n)^2) / N^2, in exact
    integer arithmetic (decimals for a large column). This reads the index, not the data.
    """
    out = {}
    for c in cols:
        if c in table.large:
            dec = "decimal(38,0)"
            idx, n = F.col("idx").cast(dec), F.col("n").cast(dec)
            total, s1, s2 = (int(x) for x in table.large[c].agg(F.sum(n), F.sum(idx * n), F.sum(idx * idx * n)).first())
        else:
            ranked = [n for _, n in table.inline.get(c, [])]
            total, s1, s2 = sum(ranked), sum(i * n for i, n in enumerate(ranked)), sum(i * i * n for i, n in enumerate(ranked))
        if total:
            out[c + suffix] = ColumnMoments(total, total, s1 / total, (total * s2 - s1 * s1) / (total * total))
    return out


def impute_exprs(moments: Moments, cols: list[str], prefix: str = "out_", suffix: str = ""):
    """Mean-imputed copies of ``cols`` (null and NaN are both missing)."""
    return [
        F.coalesce(_present(c), F.lit(moments.columns[c].mean)).alias(f"{prefix}{c}{suffix}")
        for c in moments.usable(cols)
    ]


def standardize_exprs(moments: Moments, cols: list[str], prefix: str = "z_", source_prefix: str = "out_"):
    """``(x - mean) / sample std`` of the imputed columns; 0 for a constant column."""
    out = []
    for c in moments.usable(cols):
        m = moments.columns[c]
        std = m.imputed_std
        x = F.col(f"{source_prefix}{c}")
        z = (x - F.lit(m.mean)) / F.lit(std) if std > 0 else F.lit(0.0)
        out.append(z.alias(f"{prefix}{c}"))
    return out


def impute_mean(df: DataFrame, cols: list[str], prefix: str = "out_", suffix: str = "") -> DataFrame:
    """Add mean-imputed columns ``<prefix><c><suffix>``; all-missing columns are skipped."""
    moments = fit_moments(df, cols)
    return df.select("*", *impute_exprs(moments, cols, prefix, suffix))


def standardize(df: DataFrame, cols: list[str], prefix: str = "z_") -> DataFrame:
    """Add standardized columns ``z_<c>`` (columns used as they are, missing cells mean-imputed)."""
    moments = fit_moments(df, cols)
    imputed = df.select("*", *impute_exprs(moments, cols, prefix="_imp_"))
    return imputed.select(
        *df.columns, *standardize_exprs(moments, cols, prefix=prefix, source_prefix="_imp_")
    )


@dataclass
class ModelFrame:
    """Model-ready frame plus the feature names actually used."""

    df: DataFrame
    features: list[str]
    moments: Moments


def prepare_model_frame(
    labelled: DataFrame,
    features: list[str] | None = None,
    materialize: bool = True,
    fit_on: str = "all",
    key: str = "loan_id",
) -> ModelFrame:
    """Cast, index, impute, standardize and assemble the 22 model inputs.

    Output keeps the labelled columns and adds the 14 doubles, the 8
    ``<c>_index`` columns, ``out_<c>`` (imputed), ``z_<c>`` (standardized),
    and the vectors ``features`` (imputed) and ``scaledFeatures``.
    Two aggregates are fitted: the category counts (which also give the
    moments of the index columns) and the moments of the numeric columns.

    ``fit_on="all"`` fits them on every row (as the reference does);
    ``fit_on="train"`` fits them on the training side of the hash split
    only and applies them to all rows, so test rows do not leak into the
    statistics. With ``materialize`` the cast input is written once to the
    reliable checkpoint folder, so the fits and the final pass read it
    instead of recomputing the joins that produced ``labelled``.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    wanted = features or MODEL_FEATURES
    base = cast_numeric(labelled)
    if materialize:
        base = checkpointed(base.hint("rebalance"))  # several files, so that the fits have several tasks
    fit_rows = base
    if fit_on == "train":
        fit_rows = base.where(hash_split_column(key) == F.lit("train"))
    # the two fits read the same (checkpointed) rows independently: run them as concurrent jobs.
    # Numeric moments: one aggregate over the numeric columns; index moments: from the count table.
    index_cols = [c for c in CATEGORICAL_FEATURES if c + "_index" in wanted]
    numeric_cols = [c for c in wanted if c not in {i + "_index" for i in index_cols}]
    with ThreadPoolExecutor(max_workers=2) as pool:
        table_job = pool.submit(fit_index_table, fit_rows, CATEGORICAL_FEATURES)
        moments_job = pool.submit(fit_moments, fit_rows, numeric_cols)
        table, moments = table_job.result(), moments_job.result()
    indexed = apply_index_table(base, table, CATEGORICAL_FEATURES)
    moments.columns.update(index_moments(table, index_cols))
    usable = moments.usable(wanted)
    imputed = indexed.select("*", *impute_exprs(moments, usable))
    scaled = imputed.select("*", *standardize_exprs(moments, usable))
    assembled = VectorAssembler(inputCols=[f"out_{c}" for c in usable], outputCol="features").transform(scaled)
    assembled = VectorAssembler(inputCols=[f"z_{c}" for c in usable], outputCol="scaledFeatures").transform(
        assembled
    )
    return ModelFrame(assembled, usable, moments)


def ml_feature_pipeline(
    numeric: list[str] | None = None, categorical: list[str] | None = None
) -> Pipeline:
    """The same preparation as ``pyspark.ml`` stages (index -> impute -> assemble -> scale).

    Expects numeric columns already cast to double and categorical nulls
    filled with ``''``.
    """
    from loanlens.schemas import NUMERIC_FEATURES

    numeric = numeric or NUMERIC_FEATURES
    categorical = categorical or CATEGORICAL_FEATURES
    indexed = [c + "_index" for c in categorical]
    inputs = numeric + indexed
    return Pipeline(
        stages=[
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
            Imputer(inputCols=inputs, outputCols=[f"out_{c}" for c in inputs], strategy="mean"),
            VectorAssembler(inputCols=[f"out_{c}" for c in inputs], outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaledFeatures", withMean=True, withStd=True),
        ]
    )
