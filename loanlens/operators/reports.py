"""Bounded, plot-ready summaries in place of driver-side charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.operators.cleaning import plot_numeric
from loanlens.operators.features import fit_moments, impute_exprs
from loanlens.schemas import PLOT_CATEGORICAL, PLOT_COLUMNS

PLOT_NUMERIC = [dst for _, dst in PLOT_COLUMNS if dst != PLOT_CATEGORICAL]

# --- fixed values: default bin widths of the scatter summary ---
SCORE_BIN = 10.0
BALANCE_BIN = 10_000.0


def impute_plot_columns(acq: DataFrame, cols: list[str] | None = None, keep_id: bool = False) -> DataFrame:
    """Cast the plot job's numeric fields, mean-impute them (``<c>_imputed``), keep ``LoanPurpose``."""
    cols = cols or PLOT_NUMERIC
    num = plot_numeric(acq, keep_id)
    moments = fit_moments(num, cols)
    ident = [F.col("loan_id")] if keep_id else []
    return num.select(*ident, *impute_exprs(moments, cols, prefix="", suffix="_imputed"), F.col(PLOT_CATEGORICAL))


def scatter_bins(acq: DataFrame, score_bin: float = SCORE_BIN, balance_bin: float = BALANCE_BIN) -> DataFrame:
    """Credit score x original balance, by loan purpose, as counts per 2-D bin.

    Only the two plotted fields are imputed (same values as imputing all
    eleven). Output size is bounded by the number of bins, not by rows.
    """
    score, upb = "BorrowerCreditScore", "OriginalUnpaiPrincipalBalance"
    imputed = impute_plot_columns(acq, [score, upb])
    return (
        imputed.select(
            F.col(PLOT_CATEGORICAL).alias("loan_purpose"),
            (F.floor(F.col(f"{score}_imputed") / score_bin) * score_bin).cast("double").alias("credit_score_bin"),
            (F.floor(F.col(f"{upb}_imputed") / balance_bin) * balance_bin).cast("double").alias("balance_bin"),
        )
        .groupBy("loan_purpose", "credit_score_bin", "balance_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
