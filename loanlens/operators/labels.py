"""Performance-record reduction and the foreclosure label.

Plans (checked with ``explain``):

* ``latest_entry`` is the ``row_number() = 1`` form. Spark inserts a partial
  ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
  one record per loan and a loan with a huge history cannot overload a
  reducer. It is the faster form over a whole table.
* ``latest_entry_struct`` is a ``max`` over one struct that orders records by
  parsed date and then by every other field (partial + final aggregate).
  ``max`` is associative, so the incremental and the streaming form use it.
* ``label_join`` de-duplicates the foreclosure ids (one shuffle on the id)
  and joins on that same key, so the id side is not shuffled twice. Loans
  whose id is not an integer carry a second key that no id has, taken from
  a hash of the row: they spread over all partitions. No broadcast hint: AQE
  broadcasts the id side only when its measured size is under
  ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import not_blank, parse_mdy, try_bigint
from loanlens.operators.cleaning import foreclosure_extract
from loanlens.schemas import PERF_DATE, PERF_LOAN_ID

_ORDER_DATE = "_order_date"


def _others(perf: DataFrame, key: str) -> list[str]:
    return [c for c in perf.columns if c != key]


def latest_entry(perf: DataFrame, key: str = PERF_LOAN_ID, date_col: str = PERF_DATE) -> DataFrame:
    """Latest record per loan by parsed ``MM/dd/yyyy`` date (sort-and-take-last as a ranked window).

    Ties on the date are broken by the remaining fields in column order
    (larger wins; null is smallest), so the result does not depend on the
    order in which records arrive.
    """
    if all(c in perf.columns for c in LOAN_KEYS):
        return _latest_colocated(perf, key, date_col)
    others = _others(perf, key)
    return _latest_within(perf, [key], others, date_col).select(key, *others)


def _latest_within(perf: DataFrame, keys: list[str], others: list[str], date_col: str) -> DataFrame:
    order = [parse_mdy(date_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in others]
    w = Window.partitionBy(*keys).orderBy(*order)
    return perf.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _latest_colocated(perf: DataFrame, key: str, date_col: str) -> DataFrame:
    """Over a table bucketed by loan: integer ids are reduced where they lie. Records without one are spread over the
    buckets; they are reduced there, too, and only what is left of them meets by the id's text."""
    others = [c for c in _others(perf, key) if c not in LOAN_KEYS]
    located = _latest_within(perf, [*LOAN_KEYS, key], others, date_col)
    whole = located.where("loan_spread = 0").select(key, *others)
    rest = located.where("loan_key = 0 AND loan_spread > 0").select(key, *others)
    return whole.unionByName(latest_entry(rest, key, date_col))


latest_entry_window = latest_entry


def latest_entry_struct(perf: DataFrame, key: str = PERF_LOAN_ID, date_col: str = PERF_DATE) -> DataFrame:
    """Same answer as :func:`latest_entry` as an aggregate, which also runs incrementally and over streams."""
    others = _others(perf, key)
    ordered = F.struct(parse_mdy(date_col).alias(_ORDER_DATE), *[F.col(c) for c in others])
    return (
        perf.groupBy(key)
        .agg(F.max(ordered).alias("_latest"))
        .select(key, *[F.col(f"_latest.{c}").alias(c) for c in others])
    )


def update_latest_entry(
    prior_latest: DataFrame, new_perf: DataFrame, key: str = PERF_LOAN_ID, date_col: str = PERF_DATE
) -> DataFrame:
    """Latest record per loan after new performance records arrive, without re-reading history.

    ``max`` over the total order is associative, so the latest of
    (previous latest records + new records) equals the latest over all
    records. The state carried between runs is one row per loan.
    """
    return latest_entry_struct(prior_latest.unionByName(new_perf.select(*prior_latest.columns)), key, date_col)


def foreclosure_ids(perf_or_extract: DataFrame, from_extract: bool = False) -> DataFrame:
    """Distinct foreclosed loan ids (``f_loan_id`` bigint) from performance records."""
    extract = perf_or_extract if from_extract else foreclosure_extract(perf_or_extract)
    return extract.select(try_bigint("loan_id").alias("f_loan_id")).where(F.col("f_loan_id").isNotNull()).distinct()


def distinct_ids(ids: DataFrame, col: str = "f_loan_id") -> DataFrame:
    return ids.select(col).where(F.col(col).isNotNull()).distinct()


LOAN_KEYS = ("loan_key", "loan_spread")


def with_loan_keys(df: DataFrame, names: tuple[str, str] = LOAN_KEYS) -> DataFrame:
    """Rows with the two columns that loans are dealt by: the id and 0, or 0 and a row hash above 0 where the id is no integer."""
    key = try_bigint("loan_id")
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1 << 20)) + 1
    # pmod(id, 1) is 0 for every id; unlike a literal it stays a join key, so both sides are dealt by the same two columns
    return df.withColumns({names[0]: F.coalesce(key, F.lit(0)), names[1]: F.when(key.isNull(), spread).otherwise(F.pmod(key, F.lit(1)))})


def _keyed_loans(loans: DataFrame) -> DataFrame:
    return with_loan_keys(loans, ("_k", "_s"))


def _keyed_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids with the same two keys, de-duplicated on them (one shuffle)."""
    known = ids.select("f_loan_id").where(F.col("f_loan_id").isNotNull())
    return known.select("f_loan_id", F.pmod("f_loan_id", F.lit(1)).cast("bigint").alias("_id_s")).distinct()


def _on_keys(loans: DataFrame):
    return (loans["_k"] == F.col("f_loan_id")) & (loans["_s"] == F.col("_id_s"))


def label_join(loans: DataFrame, ids: DataFrame) -> DataFrame:
    """Left join loans to distinct foreclosure ids; add ``f_loan_id`` and ``is_foreclosed`` (0/1).

    The join never changes the number of loan rows: ids are de-duplicated
    first. A loan id that is not an integer cannot match and is labelled 0;
    such rows spread over all partitions, however many there are.
    """
    keyed = _keyed_loans(loans)
    joined = keyed.join(_keyed_ids(ids), _on_keys(keyed), "left")
    return joined.drop("_k", "_s", "_id_s").withColumn(
        "is_foreclosed", F.when(F.col("f_loan_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("int")
    )


def label_join_colocated(loans: DataFrame, perf: DataFrame) -> DataFrame:
    """:func:`label_join` of loans and performance records that are bucketed alike (``sources.colocated``): no shuffle.

    Both carry the key columns from their tables; they are not part of the result.
    """
    found = perf.where(not_blank("foreclosure_date") & try_bigint("loan_id").isNotNull()).select(*LOAN_KEYS).distinct()
    ids = found.select(*(F.col(k).alias(f"_{k}") for k in LOAN_KEYS))
    on = (loans["loan_key"] == ids["_loan_key"]) & (loans["loan_spread"] == ids["_loan_spread"])
    columns = [c for c in loans.columns if c not in LOAN_KEYS]
    joined = loans.join(ids, on, "left").select(*columns, F.col("_loan_key").alias("f_loan_id"))
    return joined.withColumn("is_foreclosed", F.col("f_loan_id").isNotNull().cast("int"))


def default_members(loans: DataFrame, ids: DataFrame) -> DataFrame:
    """Loans whose id is in the foreclosure list (semi join)."""
    keyed = _keyed_loans(loans)
    return keyed.join(_keyed_ids(ids), _on_keys(keyed), "left_semi").drop("_k", "_s")


def non_default_members(loans: DataFrame, ids: DataFrame) -> DataFrame:
    """Loans whose id is not in the foreclosure list (anti join)."""
    keyed = _keyed_loans(loans)
    return keyed.join(_keyed_ids(ids), _on_keys(keyed), "left_anti").drop("_k", "_s")


def default_count(labelled: DataFrame) -> DataFrame:
    """One row: ``n_loans`` and ``n_foreclosed`` (rows that found a foreclosure id)."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.count("f_loan_id").alias("n_foreclosed"),
    )


def default_by_class(labelled: DataFrame) -> DataFrame:
    """Row count per label class."""
    return labelled.groupBy("is_foreclosed").agg(F.count(F.lit(1)).alias("n"))


def default_by_group(labelled: DataFrame, group_col: str = "origination_year") -> DataFrame:
    """Loans, foreclosures and foreclosure rate (exact ratio) per group (year by default)."""
    return labelled.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum("is_foreclosed").cast("bigint").alias("n_foreclosed"),
        (F.sum("is_foreclosed") / F.count(F.lit(1))).cast("double").alias("foreclosure_rate"),
    )


# --- fixed values: temp-view names and the joined-id column name used by existing SQL over the labels ---
LABEL_VIEW = "loan_data_default"
LABEL_VIEW_JOINED = "loan_data_default_joined"
JOINED_ID_COLUMN = "default"


def register_label_views(labelled: DataFrame) -> None:
    """Temp views for SQL over the labelled loans.

    ``loan_data_default`` holds the loan columns plus ``default`` (the joined
    foreclosure id, null when none); ``loan_data_default_joined`` adds
    ``is_foreclosed``. SQL written against those names runs unchanged.
    """
    base = labelled.withColumnRenamed("f_loan_id", JOINED_ID_COLUMN)
    base.drop("is_foreclosed").createOrReplaceTempView(LABEL_VIEW)
    base.createOrReplaceTempView(LABEL_VIEW_JOINED)


def labelled_loans(loans: DataFrame, perf: DataFrame) -> DataFrame:
    """Engineered loans joined to the foreclosures found in ``perf``."""
    return label_join(loans, foreclosure_ids(perf))
