"""Command-line jobs (run with ``spark-submit`` or ``python -m loanlens.plans.cli``).

    foreclosures  performance files -> (loan id, foreclosure date) table
    latest        performance files -> latest record per loan
    report        acquisition + performance (or a foreclosure list) -> statistics,
                  model metrics, curves, confusion tables; ``--by-year`` for the
                  per-file-year loop
    scatter       acquisition files -> credit score x balance bins by loan purpose
    land          raw text files -> Parquet partitioned by source file and year

A report's tables are keyed by year (0: all years in one) and published together: a run replaces its own
years in all of them and leaves the others (:mod:`loanlens.sources.results`).

Outputs are Parquet folders under ``--out``; ``--text`` writes ``|``-separated
bzip2 text instead where a record table is produced.
"""

from __future__ import annotations

import argparse
import os

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.cleaning import foreclosure_extract, prepare_loans
from loanlens.operators.labels import foreclosure_ids, label_join, latest_entry, update_latest_entry
from loanlens.operators.models import MODEL_FITTERS
from loanlens.operators.reports import scatter_bins
from loanlens.plans.jobs import model_report, yearly_report
from loanlens.schemas import ACQ_FIELDS, PERF_FIELDS, perf_fields
from loanlens.session import RECOMMENDED_CONF, ensure_checkpoint_dir, release_checkpoints
from loanlens.sources.commit import Folder
from loanlens.sources.landing import MANIFEST, SOURCE_FILE, land_acquisition, land_performance, read_landed
from loanlens.sources.results import publish
from loanlens.sources.sinks import write_parquet
from loanlens.sources.text import (
    format_legacy_foreclosures,
    read_acquisition,
    read_legacy_foreclosures,
    read_performance,
    write_pipe_text,
)


def _session(app: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if not SparkConf().contains("spark.master"):
        b = b.master("local[*]")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _read(spark: SparkSession, path: str, kind: str, a) -> DataFrame:
    if a.input_format == "parquet":
        return read_landed(spark, path) if Folder(spark, path).exists(MANIFEST) else spark.read.parquet(path)
    if kind == "acq":
        return read_acquisition(spark, path)
    return read_performance(spark, path, perf_fields(a.perf_fields))


def _record(perf: DataFrame) -> DataFrame:
    """Performance records without the columns that landing adds, in field order."""
    return perf.drop(SOURCE_FILE, "reporting_year")


def _write(df: DataFrame, path: str, text: bool, fields: list[str] | None = None) -> None:
    if text:
        write_pipe_text(df.select(*(fields or df.columns)), path)
    else:
        write_parquet(df, path)


def cmd_foreclosures(spark, a):
    extract = foreclosure_extract(_read(spark, a.perf, "perf", a))
    if getattr(a, "legacy_text", False):
        format_legacy_foreclosures(extract).write.mode("overwrite").option("compression", "bzip2").text(a.out)
    else:
        _write(extract, a.out, a.text)


def cmd_latest(spark, a):
    perf = _record(_read(spark, a.perf, "perf", a))
    if getattr(a, "prior", None):
        prior = spark.read.parquet(a.prior)
        result = update_latest_entry(prior, perf.select(*prior.columns))
    else:
        result = latest_entry(perf)
    _write(result, a.out, a.text)


def cmd_scatter(spark, a):
    write_parquet(scatter_bins(_read(spark, a.acq, "acq", a).select(*ACQ_FIELDS)), a.out)


def cmd_land(spark, a):
    if a.acq:
        land_acquisition(spark, a.acq, os.path.join(a.out, "acquisition"), replace=a.replace)
    if a.perf:
        land_performance(spark, a.perf, os.path.join(a.out, "performance"), perf_fields(a.perf_fields), replace=a.replace)


# --- fixed values: text output folders of the per-year model job, per result ---
LEGACY_FOLDERS = {
    "pval": "pval",
    "logistic_regression": "logisticRegression",
    "random_forest": "randomForest",
    "gradient_boosted_trees": "gradientBoost",
}


def _legacy_outputs(hypotheses: DataFrame, metrics: DataFrame, models: list[str], under: str = "") -> dict[str, DataFrame]:
    """The text layout older consumers read, folder by folder: p-values one per line (features in order,
    intercept last) and each model's evaluator area under ROC."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")
    auc = metrics.where(F.col("metric") == "areaUnderROC")
    out = {LEGACY_FOLDERS["pval"]: hypotheses.orderBy("position").select(value("p"))}
    out |= {LEGACY_FOLDERS[m]: auc.where(F.col("model") == m).select(value("value")) for m in models}
    return {os.path.join(under, name): df for name, df in out.items()}


def _ids(spark, a) -> DataFrame:
    """Foreclosure ids from a list, or from performance records."""
    if not a.foreclosures:
        return foreclosure_ids(_read(spark, a.perf, "perf", a))
    if a.foreclosures_format == "legacy":
        return read_legacy_foreclosures(spark, a.foreclosures)
    return spark.read.parquet(a.foreclosures).select(F.col("loan_id").try_cast("bigint").alias("f_loan_id"))


def cmd_report(spark, a):
    acq = _read(spark, a.acq, "acq", a)
    models = a.models.split(",") if a.models else list(MODEL_FITTERS)
    if a.by_year:
        year_col = a.year_col or ("file_year" if "file_year" in acq.columns else "origination_year")
        rep = yearly_report(spark, acq, None, [a.year] if a.year else None, models, year_col, fit_on=a.fit_on, ids=_ids(spark, a))
        texts = {}
        if a.legacy_output:
            for year in rep.years:
                of = lambda df, y=year: df.where(F.col("year").eqNullSafe(F.lit(y)))
                texts |= _legacy_outputs(of(rep.hypotheses), of(rep.metrics), models, str(year))
        publish(spark, rep.tables(), a.out, [a.year] if a.year else rep.years, texts)
        return
    lab = label_join(prepare_loans(acq), _ids(spark, a))
    rep = model_report(spark, lab, year=a.year, models=models, fit_on=a.fit_on)
    year = a.year or 0  # 0: all years
    tables = {"correlation": rep.correlation, "hypotheses": rep.hypotheses, "metrics": rep.metrics}
    tables |= {f"curves/{name}": df for name, df in rep.curves.items()} | {f"confusion/{name}": df for name, df in rep.confusion.items()}
    keyed = {name: df.withColumn("year", F.lit(year)) for name, df in tables.items()}
    publish(spark, keyed, a.out, [year], _legacy_outputs(rep.hypotheses, rep.metrics, models) if a.legacy_output else None)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="loanlens")
    p.add_argument("--input-format", choices=["text", "parquet"], default="text")
    p.add_argument("--perf-fields", type=int, default=len(PERF_FIELDS), help="fields of a performance line (text input); wider lines are an error")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("foreclosures", "latest"):
        s = sub.add_parser(name)
        s.add_argument("--perf", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--text", action="store_true", help="write |-separated bzip2 text")
        if name == "latest":
            s.add_argument("--prior", help="previous latest-record table (Parquet) to update with --perf")
        if name == "foreclosures":
            s.add_argument("--legacy-text", action="store_true", help="write one tuple-text line per record (bzip2)")
    s = sub.add_parser("land", help="convert raw text files to partitioned Parquet once")
    s.add_argument("--acq")
    s.add_argument("--perf")
    s.add_argument("--out", required=True)
    s.add_argument("--replace", action="store_true", help="replace the rows of files that are already landed (default: leave such files out)")
    s = sub.add_parser("scatter")
    s.add_argument("--acq", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("report")
    s.add_argument("--acq", required=True)
    s.add_argument("--perf")
    s.add_argument("--foreclosures", help="foreclosure list instead of --perf")
    s.add_argument("--foreclosures-format", choices=["legacy", "parquet"], default="parquet")
    s.add_argument("--out", required=True)
    s.add_argument("--year", type=int)
    s.add_argument("--by-year", action="store_true")
    s.add_argument("--year-col", help="year column for --by-year (default: file_year from the file name when present)")
    s.add_argument("--fit-on", choices=["all", "train"], default="all", help="rows the feature statistics are fitted on")
    s.add_argument("--legacy-output", action="store_true", help="also write pval/ and per-model AUC text folders")
    s.add_argument("--models", help="comma list of logistic_regression,random_forest,gradient_boosted_trees")
    a = p.parse_args(argv)
    if a.cmd == "report" and not (a.perf or a.foreclosures):
        p.error("report needs --perf or --foreclosures")
    spark = _session(f"loanlens-{a.cmd}")
    commands = {
        "foreclosures": cmd_foreclosures,
        "latest": cmd_latest,
        "scatter": cmd_scatter,
        "report": cmd_report,
        "land": cmd_land,
    }
    try:
        commands[a.cmd](spark, a)
    finally:
        release_checkpoints(spark)


if __name__ == "__main__":
    main()
