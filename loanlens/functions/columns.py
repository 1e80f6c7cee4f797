"""Scalar column functions.

Raw fields are text in which a blank (empty or whitespace) means "missing";
readers may also hand over SQL null. Every helper here treats both the same
and never throws on malformed text (ANSI mode is on, so plain ``cast`` would).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.schemas import PERF_DATE_FORMAT

# --- fixed values: defaults of the credit-score rule ---
CREDIT_SCORE_DEFAULT = 1000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, with blank turned into null."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def is_blank(col: Column | str) -> Column:
    return blank_to_null(col).isNull()


def not_blank(col: Column | str) -> Column:
    return blank_to_null(col).isNotNull()


def try_int(col: Column | str) -> Column:
    return blank_to_null(col).try_cast("int")


def try_bigint(col: Column | str) -> Column:
    return blank_to_null(col).try_cast("bigint")


def try_double(col: Column | str) -> Column:
    return blank_to_null(col).try_cast("double")


def missing_double(col: Column | str) -> Column:
    """True when a double is null or NaN (both count as missing)."""
    c = _c(col)
    return c.isNull() | F.isnan(c)


def month_part(col: Column | str) -> Column:
    """Month of a ``MM/yyyy`` (or ``MM/...``) text date, null when malformed."""
    return F.get(F.split(blank_to_null(col), "/"), 0).try_cast("int")


def year_part(col: Column | str) -> Column:
    """Year of a ``MM/yyyy`` text date, null when malformed."""
    return F.get(F.split(blank_to_null(col), "/"), 1).try_cast("int")


def parse_mdy(col: Column | str) -> Column:
    """``MM/dd/yyyy`` text to a date; null when blank or unparsable."""
    return F.try_to_date(blank_to_null(col), PERF_DATE_FORMAT)


def mi_flag(insurance_percentage: Column | str) -> Column:
    """1 when the insurance percentage is an integer greater than 0, else 0."""
    pct = try_int(insurance_percentage)
    return F.when(pct > 0, F.lit(1)).otherwise(F.lit(0)).cast("int")


def credit_or_default(col: Column | str) -> Column:
    """Credit score as int, ``CREDIT_SCORE_DEFAULT`` when blank or not an integer."""
    return F.coalesce(try_int(col), F.lit(CREDIT_SCORE_DEFAULT))


def min_credit_score(borrower: Column | str, co_borrower: Column | str) -> Column:
    """Smaller of the two scores; a missing score counts as the default."""
    return F.least(credit_or_default(borrower), credit_or_default(co_borrower)).cast("int")


# --- fixed values: what a display label leaves out of a feature name ---
LABEL_PREFIX, LABEL_SUFFIX = "out_", "_index"


def readable_label(col: Column | str) -> Column:
    """Feature name to display label: without the leading ``out_`` and the trailing ``_index``, each part capitalised."""
    core = F.regexp_replace(F.regexp_replace(_c(col), f"^{LABEL_PREFIX}", ""), f"{LABEL_SUFFIX}$", "")
    parts = F.filter(F.split(core, "_"), lambda p: p != "")
    return F.array_join(F.transform(parts, F.initcap), " ")


def readable_label_py(name: str) -> str:
    """:func:`readable_label` of one name on the driver."""
    core = name.removeprefix(LABEL_PREFIX).removesuffix(LABEL_SUFFIX)
    return " ".join(part.capitalize() for part in core.split("_") if part)
