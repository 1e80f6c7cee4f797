"""Row-level cleaning of acquisition records: narrow, shuffle-free projections and filters.

All steps are plain column expressions, so Spark pipelines them into one
whole-stage-codegen span with the scan. Catalyst moves the filter
predicates down to the scan (below any joins that produced the input);
they are expressions over the text fields, so they run on the decoded
rows rather than as Parquet pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions import (
    blank_to_null,
    mi_flag,
    min_credit_score,
    month_part,
    not_blank,
    try_double,
    year_part,
)
from loanlens.schemas import ACQ_FIELDS, DROP_NA_SUBSET, LOAN_FIELDS, NUMERIC_FEATURES, PLOT_COLUMNS

_DATE_PARTS = ["origination_month", "origination_year", "first_payment_month", "first_payment_year"]


def _carry(df: DataFrame) -> list[str]:
    """Extra columns (e.g. ``file_year``) carried past the layout columns."""
    return [c for c in df.columns if c not in ACQ_FIELDS and c not in LOAN_FIELDS and c not in _DATE_PARTS]


def month_year_parts(acq: DataFrame) -> DataFrame:
    """Origination / first-payment ``MM/yyyy`` text to four int columns; drop the raw dates and the last field."""
    head = ACQ_FIELDS[: ACQ_FIELDS.index("original_loan_term") + 1]
    tail = ACQ_FIELDS[ACQ_FIELDS.index("ltv") : ACQ_FIELDS.index("relocation_mortgage_indicator") + 1]
    return acq.select(
        *head,
        month_part("origination_date").alias("origination_month"),
        year_part("origination_date").alias("origination_year"),
        month_part("first_payment_date").alias("first_payment_month"),
        year_part("first_payment_date").alias("first_payment_year"),
        *tail,
        *_carry(acq),
    )


def year_credit_filter(parts: DataFrame, min_year: int = 2000) -> DataFrame:
    """Keep loans originated in or after ``min_year`` with at least one credit score present.

    A null (unparsable) origination year fails the test.
    """
    return parts.where(
        (F.col("origination_year") >= F.lit(min_year))
        & (not_blank("borrower_credit_score") | not_blank("co_borrower_credit_score"))
    )


def engineer_features(parts: DataFrame) -> DataFrame:
    """Add ``min_credit_score`` and the mortgage-insurance flag ``mi``; drop their inputs,
    ``zip`` and ``mortgage_insurance_type`` (24 layout columns remain, see ``LOAN_FIELDS``)."""
    derived = {
        "min_credit_score": min_credit_score("borrower_credit_score", "co_borrower_credit_score"),
        "mi": mi_flag("insurance_percentage"),
    }
    cols = [derived[c].alias(c) if c in derived else F.col(c) for c in LOAN_FIELDS]
    return parts.select(*cols, *_carry(parts))


def prepare_loans(acq: DataFrame, min_year: int = 2000) -> DataFrame:
    """Raw acquisition -> date parts -> year/credit filter -> engineered 24-column loans."""
    return engineer_features(year_credit_filter(month_year_parts(acq), min_year))


def cast_numeric(loans: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Cast the numeric model inputs to double; malformed or blank text becomes null, numbers are cast as they are."""
    targets = set(cols or NUMERIC_FEATURES)

    def as_double(name: str, kind: str):
        return try_double(name) if kind == "string" else F.col(name).cast("double")

    return loans.select(*[as_double(c, kind).alias(c) if c in targets else F.col(c) for c, kind in loans.dtypes])


def blank_to_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace every blank field by 0 (``'0'`` for text columns, ``0`` for numeric ones)."""
    targets = set(cols or df.columns)
    out = []
    for field in df.schema.fields:
        c = field.name
        if c not in targets:
            out.append(F.col(c))
        elif field.dataType.simpleString() == "string":
            out.append(F.coalesce(blank_to_null(c), F.lit("0")).alias(c))
        else:
            out.append(F.coalesce(F.col(c), F.lit(0).cast(field.dataType)).alias(c))
    return df.select(*out)


def drop_na_subset(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``subset`` columns."""
    return df.na.drop(how="any", subset=subset or DROP_NA_SUBSET)


def foreclosure_extract(perf: DataFrame) -> DataFrame:
    """``(loan_id, foreclosure_date)`` for every performance record that has a foreclosure date."""
    return perf.where(not_blank("foreclosure_date")).select(
        blank_to_null("loan_id").alias("loan_id"), F.trim("foreclosure_date").alias("foreclosure_date")
    )


def plot_projection(acq: DataFrame, keep_id: bool = False) -> DataFrame:
    """The plot job's 12 fields under their display names (still text)."""
    cols = [F.col(src).alias(dst) for src, dst in PLOT_COLUMNS]
    return acq.select(*([F.col("loan_id")] if keep_id else []), *cols)


def plot_numeric(acq: DataFrame, keep_id: bool = False) -> DataFrame:
    """Plot projection with the 11 numeric fields cast to double."""
    proj = plot_projection(acq, keep_id)
    return proj.select(
        *[
            F.col(c) if c in ("loan_id", "LoanPurpose") else try_double(c).alias(c)
            for c in proj.columns
        ]
    )
