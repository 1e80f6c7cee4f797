"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are the acquisition / performance records derived from the driver
tables (``loanlens.sources.tables``); every step named by a query runs on
them through the operators. Doubles that come out of floating-point sums
(means, standard deviations, correlations) are rounded to ``DIGITS`` so the
DuckDB oracle can compare them; ratios of integers are left exact.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions import try_bigint
from loanlens.operators import cleaning, evaluate, features, grouped, labels, newton, reports, stats
from loanlens.operators.models import hash_split_column
from loanlens.plans import jobs
from loanlens.schemas import (
    ACQ_FIELDS,
    CATEGORICAL_FEATURES,
    CONFUSION_THRESHOLD,
    PERF_FIELDS,
    PLOT_CATEGORICAL,
    SPLIT_SEED,
    SPLIT_WEIGHTS,
)
from loanlens.session import checkpointed, scratch_folder
from loanlens.sources import colocated, landing, results, tables, text

DIGITS = 6
MOMENT_DIGITS = 4
SCORE_DIGITS = 6
FIRST_ROWS = 5


def rounded(col: Column | str, digits: int = DIGITS) -> Column:
    """Round a double; a rounded zero is always +0.0."""
    c = F.round(F.col(col) if isinstance(col, str) else col, digits)
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def credit_risk_score(col: str = "min_credit_score") -> Column:
    """Scorecard baseline: ``1 - min_credit_score / 1000`` (lower score, higher risk)."""
    return F.lit(1.0) - F.col(col).cast("double") / F.lit(1000.0)


# ---- shared inputs ---------------------------------------------------------


def acq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.acquisition_records(spark, sf_dir)


def perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.performance_records(spark, sf_dir)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.prepare_loans(acq(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.labelled(acq(spark, sf_dir), perf(spark, sf_dir))


def model_frame(spark: SparkSession, sf_dir: str) -> features.ModelFrame:
    return features.prepare_model_frame(labelled(spark, sf_dir))


# ---- sources / projections / filters ---------------------------------------


def q_parse_pipe_records(spark, sf_dir):
    """Acquisition records rendered as ``|`` lines (26 fields), then split back into named fields."""
    lines = text.to_pipe_lines(acq(spark, sf_dir), ACQ_FIELDS[:-1], trailing_field=True)
    return text.parse_pipe_lines(lines, ACQ_FIELDS)


def q_pipe_text_roundtrip(spark, sf_dir):
    """Acquisition records written as bzip2 pipe text (one folder a file year) and read by the file reader."""
    folder = scratch_folder(spark, "text")
    records = tables.acquisition_records(spark, sf_dir, with_file_year=True)
    named = records.withColumn("Acquisition", F.col("file_year"))
    text.write_pipe_text(named.select(*ACQ_FIELDS, "Acquisition"), folder, partition_by=["Acquisition"])
    # the year stands in each folder's name: Acquisition=2000
    return text.read_acquisition(spark, f"{folder}/Acquisition=*").select(*ACQ_FIELDS, "file_year")


def q_landed_performance(spark, sf_dir):
    """Performance records written as bzip2 text in two deliveries, landed one after the other (the first one
    offered twice), and read back from Parquet with all fields and the reporting year."""
    folder = scratch_folder(spark, "text")
    records = perf(spark, sf_dir)
    second = F.col("loan_id").cast("bigint") % 2 == 0
    text.write_pipe_text(records.where(~second), f"{folder}/first")
    text.write_pipe_text(records.where(second), f"{folder}/second")
    landing.land_performance(spark, f"{folder}/first", f"{folder}/landed")
    landed = landing.land_performance(spark, [f"{folder}/first", f"{folder}/second"], f"{folder}/landed")
    return landed.select(*PERF_FIELDS, "reporting_year")


def q_landing_manifest(spark, sf_dir):
    """Performance records landed in two deliveries, with half of the second one's rows already there as a job that died
    before its commit leaves them: rows a reporting year, and what the manifest and a recount say of all files."""
    folder = scratch_folder(spark, "text")
    dst = f"{folder}/landed"
    records = perf(spark, sf_dir)
    loan = F.col("loan_id").cast("bigint")
    text.write_pipe_text(records.where(loan % 2 == 1), f"{folder}/first")
    text.write_pipe_text(records.where(loan % 2 == 0), f"{folder}/second")
    landing.land_performance(spark, f"{folder}/first", dst)
    died = text.read_performance(spark, f"{folder}/second").withColumns(
        {"reporting_year": landing.reporting_year(), landing.SOURCE_FILE: landing.source_key()}
    )
    died.where(loan % 4 == 0).write.mode("append").partitionBy(landing.SOURCE_FILE, "reporting_year").parquet(dst)
    landed = landing.land_performance(spark, [f"{folder}/first", f"{folder}/second"], dst)
    files = landing.check_landing(spark, dst).agg(F.sum("rows").alias("manifest_rows"), F.bool_and("ok").alias("files_ok")).first()
    return landed.groupBy("reporting_year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(files["manifest_rows"]).cast("long").alias("manifest_rows"),
        F.lit(files["files_ok"]).alias("files_ok"),
    )


def q_reconciled_lines(spark, sf_dir):
    """Acquisition lines, of which every tenth has two fields too many and another tenth is cut short, read with every
    line accounted for: loans by verdict, and the counts of the read."""
    folder = scratch_folder(spark, "text")
    lines = text.to_pipe_lines(acq(spark, sf_dir), ACQ_FIELDS[:-1], trailing_field=True)
    digit = F.regexp_extract("value", r"^\d*(\d)\|", 1)
    cut = F.regexp_extract("value", r"^((?:[^|]*\|){19}[^|]*)", 1)
    odd = F.when(digit == "3", F.concat("value", F.lit("|x|y"))).when(digit == "7", cut).otherwise(F.col("value"))
    lines.select(odd.alias("value")).write.option("compression", "bzip2").text(folder)
    read = text.read_reconciled(spark, folder, ACQ_FIELDS)
    good = read.rows.select(F.lit("good").alias("verdict"), "loan_id", F.lit(len(ACQ_FIELDS)).alias("n_fields"))
    bad = read.rejected.select("verdict", F.substring_index("line", "|", 1).alias("loan_id"), F.size(F.split("line", r"\|", -1)).alias("n_fields"))
    counts = [F.lit(read.counts[k]).cast("long").alias(f"n_{k}") for k in ("lines", "rows", "rejected")]
    return good.unionByName(bad).select("*", *counts)


def q_foreclosure_extract(spark, sf_dir):
    """Performance records that carry a foreclosure date, as (loan_id, foreclosure_date)."""
    return cleaning.foreclosure_extract(perf(spark, sf_dir))


def q_legacy_foreclosure_ids(spark, sf_dir):
    """Foreclosure extract written as tuple-text lines, parsed back to typed ids."""
    lines = text.format_legacy_foreclosures(cleaning.foreclosure_extract(perf(spark, sf_dir)))
    return text.parse_legacy_foreclosures(lines)


def q_latest_entry(spark, sf_dir):
    """Latest performance record per loan (ranked window, total order on ties)."""
    return labels.latest_entry(perf(spark, sf_dir))


def q_latest_entry_window(spark, sf_dir):
    """The same by the explicit name of the window form."""
    return labels.latest_entry_window(perf(spark, sf_dir))


def q_latest_entry_struct(spark, sf_dir):
    """Latest performance record per loan (aggregate form, as the incremental and streaming jobs use); same rows."""
    return labels.latest_entry_struct(perf(spark, sf_dir))


def q_latest_entry_incremental(spark, sf_dir):
    """Latest record per loan kept incrementally: records reported before 1998 are reduced first,
    then that state is updated with every later record (same answer as a full pass)."""
    p = perf(spark, sf_dir)
    year = F.get(F.split("reporting_date", "/"), 2).try_cast("int")
    prior = labels.latest_entry_struct(p.where(year < 1998))
    return labels.update_latest_entry(prior, p.where((year >= 1998) | year.isNull()))


def q_month_year_parts(spark, sf_dir):
    """Acquisition records with origination / first-payment month and year as ints."""
    return cleaning.month_year_parts(acq(spark, sf_dir))


def q_year_credit_filter(spark, sf_dir):
    """Date-part records originated in 2000 or later with at least one credit score."""
    return cleaning.year_credit_filter(cleaning.month_year_parts(acq(spark, sf_dir)))


def q_engineered_features(spark, sf_dir):
    """Filtered records with min_credit_score and the mortgage-insurance flag (24 columns)."""
    return loans(spark, sf_dir)


def q_cast_numeric(spark, sf_dir):
    """Engineered loans with the 14 numeric inputs cast to double."""
    return cleaning.cast_numeric(loans(spark, sf_dir))


def q_blank_to_zero(spark, sf_dir):
    """Date-part records with every blank field replaced by 0."""
    return cleaning.blank_to_zero(cleaning.month_year_parts(acq(spark, sf_dir)))


def q_drop_na_subset(spark, sf_dir):
    """Cast loans without nulls in cltv, borrower_count, dti and min_credit_score."""
    return cleaning.drop_na_subset(cleaning.cast_numeric(loans(spark, sf_dir)))


def q_first_rows(spark, sf_dir):
    """The plot job's 12 fields for the five lowest loan ids."""
    proj = cleaning.plot_projection(acq(spark, sf_dir), keep_id=True)
    return proj.orderBy(try_bigint("loan_id")).limit(FIRST_ROWS)


# ---- joins and aggregates ----------------------------------------------------


def q_label_join(spark, sf_dir):
    """Engineered loans left-joined to distinct foreclosure ids, with is_foreclosed."""
    return labelled(spark, sf_dir)


def _colocated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    folder = scratch_folder(spark, "colocated")
    return colocated.write_colocated(acq(spark, sf_dir), f"{folder}/acquisition"), colocated.write_colocated(perf(spark, sf_dir), f"{folder}/performance")


def q_colocated_latest_entry(spark, sf_dir):
    """Latest performance record per loan over a table bucketed by loan: no shuffle."""
    return labels.latest_entry(_colocated(spark, sf_dir)[1])


def q_colocated_label_join(spark, sf_dir):
    """Engineered loans joined to their foreclosures, both from tables bucketed by loan: no shuffle."""
    loans_at, perf_at = _colocated(spark, sf_dir)
    return labels.label_join_colocated(cleaning.prepare_loans(loans_at), perf_at)


def q_default_members(spark, sf_dir):
    """Engineered loans whose id is in the foreclosure list (semi join)."""
    return labels.default_members(loans(spark, sf_dir), labels.foreclosure_ids(perf(spark, sf_dir)))


def q_non_default_members(spark, sf_dir):
    """Engineered loans whose id is not in the foreclosure list (anti join)."""
    return labels.non_default_members(loans(spark, sf_dir), labels.foreclosure_ids(perf(spark, sf_dir)))


def q_default_count(spark, sf_dir):
    """Labelled loans and how many found a foreclosure id."""
    return labels.default_count(labelled(spark, sf_dir))


def q_default_by_class(spark, sf_dir):
    """Labelled loans per label class."""
    return labels.default_by_class(labelled(spark, sf_dir))


def q_default_by_year(spark, sf_dir):
    """Flagship: loans, foreclosures and foreclosure rate per origination year."""
    return labels.default_by_group(labelled(spark, sf_dir), "origination_year")


def q_default_by_year_class(spark, sf_dir):
    """Minimum slice: rows per (origination year, label)."""
    return labelled(spark, sf_dir).groupBy("origination_year", "is_foreclosed").agg(F.count(F.lit(1)).alias("n"))


# ---- features ----------------------------------------------------------------


def q_impute_mean(spark, sf_dir):
    """The 22 model inputs mean-imputed (out_<c>), per labelled loan."""
    mf = model_frame(spark, sf_dir)
    return mf.df.select("loan_id", *[rounded(f"out_{c}").alias(f"out_{c}") for c in mf.features])


def q_impute_mean_plot(spark, sf_dir):
    """The plot job's 11 numeric fields mean-imputed (<c>_imputed) over all acquisition records."""
    imp = reports.impute_plot_columns(acq(spark, sf_dir), keep_id=True)
    return imp.select(
        "loan_id", *[rounded(c).alias(c) for c in imp.columns if c.endswith("_imputed")], PLOT_CATEGORICAL
    )


def q_string_index_freq(spark, sf_dir):
    """The 8 categorical columns indexed by descending frequency (ties alphabetical)."""
    idx = features.string_index(labelled(spark, sf_dir), CATEGORICAL_FEATURES)
    return idx.select("loan_id", *[f"{c}_index" for c in CATEGORICAL_FEATURES])


def q_label_encode_alpha(spark, sf_dir):
    """The 8 categorical columns encoded in alphabetical order."""
    enc = features.label_encode(labelled(spark, sf_dir), CATEGORICAL_FEATURES)
    return enc.select("loan_id", *[f"{c}_code" for c in CATEGORICAL_FEATURES])


def q_standardize(spark, sf_dir):
    """The 22 imputed model inputs standardized with the sample standard deviation."""
    mf = model_frame(spark, sf_dir)
    return mf.df.select("loan_id", *[rounded(f"z_{c}").alias(f"z_{c}") for c in mf.features])


def q_correlation_long(spark, sf_dir):
    """Pearson correlation of the 22 imputed inputs, lower triangle, readable labels."""
    mf = model_frame(spark, sf_dir)
    corr = stats.correlation_long(mf.df, [f"out_{c}" for c in mf.features], vector_col="features")
    return corr.select("feature_a", "feature_b", rounded("r").alias("r"))


def q_hash_split(spark, sf_dir):
    """Train / test side of every labelled loan from the md5 hash split (70/30, seed 11)."""
    lab = labelled(spark, sf_dir)
    return lab.select("loan_id", hash_split_column("loan_id", SPLIT_WEIGHTS, seed=SPLIT_SEED).alias("split"))


# ---- evaluation on the scorecard baseline --------------------------------------


def _scored(spark, sf_dir) -> DataFrame:
    lab = labelled(spark, sf_dir)
    return lab.select("loan_id", F.col("is_foreclosed").alias("label"), credit_risk_score().alias("score"))


def q_roc_curve(spark, sf_dir):
    """ROC points of the scorecard score (rounded to 3 digits) against the label."""
    return evaluate.roc_curve(_scored(spark, sf_dir), "label", "score", digits=3)


def q_pr_curve(spark, sf_dir):
    """Precision / recall points of the scorecard score (rounded to 3 digits)."""
    return evaluate.pr_curve(_scored(spark, sf_dir), "label", "score", digits=3)


def q_exact_auc(spark, sf_dir):
    """Exact rank-sum AUC of the scorecard score."""
    return evaluate.exact_auc(_scored(spark, sf_dir), "label", "score")


def q_confusion_at_threshold(spark, sf_dir):
    """Confusion counts of the scorecard score at the fixed threshold."""
    return evaluate.confusion_at_threshold(_scored(spark, sf_dir), "label", "score")


def q_scatter_bins(spark, sf_dir):
    """Credit score x original balance counts per loan purpose, in 2-D bins."""
    return reports.scatter_bins(acq(spark, sf_dir))


# ---- statistics and models (no SQL oracle) ------------------------------------


def q_hypothesis_table(spark, sf_dir):
    """GLM (Gaussian, identity, L2 0.3) coefficients, std errors, t, p and Bonferroni per input."""
    md = jobs.model_data(labelled(spark, sf_dir))
    data = md.data.select(F.col("features").alias("scaledFeatures"), F.col("label").alias("is_foreclosed"))
    return _rounded_tests(stats.hypothesis_table(spark, data, md.frame.features))


def _rounded_tests(table: DataFrame) -> DataFrame:
    digits = {"t": 4, "p_bonferroni": 4, "p_bonferroni_capped": 4, "coefficient": DIGITS, "std_error": DIGITS, "p": DIGITS}
    return table.select(*(rounded(c, digits[c]).alias(c) if c in digits else F.col(c) for c in table.columns))


def _year_frame(spark, sf_dir) -> jobs.YearFrame:
    return jobs.year_frame(jobs.labelled(tables.acquisition_records(spark, sf_dir, with_file_year=True), perf(spark, sf_dir)))


def q_yearly_correlation(spark, sf_dir):
    """Pearson correlation of the 22 inputs in every file year, from one grouped aggregate."""
    frame = _year_frame(spark, sf_dir)
    corr = grouped.group_correlations(frame.moments, frame.stats)
    return corr.select("year", "feature_a", "feature_b", rounded("r").alias("r"))


def q_yearly_hypotheses(spark, sf_dir):
    """GLM tests of every file year, solved from that year's moments in column expressions."""
    frame = _year_frame(spark, sf_dir)
    return _rounded_tests(grouped.group_hypotheses(frame.moments, frame.stats))


def _yearly_logistic(spark, sf_dir) -> tuple[jobs.YearFrame, DataFrame, DataFrame]:
    """The frame of all years, its test side, and the coefficients fitted on its training side."""
    frame = _year_frame(spark, sf_dir)
    side = hash_split_column("loan_id", SPLIT_WEIGHTS, seed=SPLIT_SEED)
    train, test = frame.data.where(side == "train"), frame.data.where(side == "test")
    return frame, test, newton.fit_logistic_groups(train, "year", len(frame.stats.features))


def q_yearly_logistic(spark, sf_dir):
    """Coefficients of the ridge logistic regression of every file year, fitted on the training side by Newton steps."""
    frame, _, fitted = _yearly_logistic(spark, sf_dir)
    out = newton.coefficient_table(fitted, "year", frame.stats.features)
    return out.select("year", "position", "feature", rounded("coefficient").alias("coefficient"))


def q_yearly_logistic_auc(spark, sf_dir):
    """Areas under ROC and PR, rank-sum AUC and rows of that regression on the test side of every file year."""
    _, test, fitted = _yearly_logistic(spark, sf_dir)
    scored = newton.score_groups(test, fitted, "year", []).withColumn("score", F.round("score", 9))
    totals = grouped.group_totals(checkpointed(grouped.group_histogram(scored, ["year"])), ["year"])
    return grouped.group_metrics(totals, ["year"]).select("year", "metric", rounded("value").alias("value"))


def _year_totals(spark, sf_dir) -> DataFrame:
    lab = jobs.labelled(tables.acquisition_records(spark, sf_dir, with_file_year=True), perf(spark, sf_dir))
    scored = lab.select(F.col("file_year").alias("year"), F.col("is_foreclosed").alias("label"), credit_risk_score().alias("score"))
    return grouped.group_totals(checkpointed(grouped.group_histogram(scored, ["year"])), ["year"])


def q_yearly_curves(spark, sf_dir):
    """ROC / PR points of the scorecard score in every file year, one a distinct score."""
    return grouped.group_curves(_year_totals(spark, sf_dir), ["year"])


def q_yearly_metrics(spark, sf_dir):
    """Areas under the ROC and PR curves, rank-sum AUC and rows of the scorecard score in every file year."""
    return grouped.group_metrics(_year_totals(spark, sf_dir), ["year"]).select("year", "metric", rounded("value", 9).alias("value"))


def q_bonferroni(spark, sf_dir):
    """Bonferroni correction (raw and capped) of a p column: each category's share of its column, one hypothesis a category."""
    counts = features.category_counts(labelled(spark, sf_dir), CATEGORICAL_FEATURES)
    total = labelled(spark, sf_dir).count()
    p = counts.select("column", "value", (F.col("n").cast("double") / F.lit(float(total))).alias("p"))
    return stats.bonferroni(p, len(CATEGORICAL_FEATURES))


def q_glm_moments(spark, sf_dir):
    """Row count, means, x'x and x'y of the 22 standardized inputs and the label."""
    mf = model_frame(spark, sf_dir)
    out = stats.glm_moments(mf.df, mf.features)
    return out.select("moment", "a", "b", rounded("value", MOMENT_DIGITS).alias("value"))


def _linear_scored(spark, sf_dir) -> DataFrame:
    """A logistic score with fixed coefficients over the 22 standardized inputs."""
    mf = model_frame(spark, sf_dir)
    logit = sum((F.lit(w) * F.round(f"z_{c}", DIGITS) for c, w in zip(mf.features, linear_weights(len(mf.features)), strict=True)), F.lit(0.0))
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), SCORE_DIGITS)
    return mf.df.select("loan_id", F.col("is_foreclosed").alias("label"), score.alias("score"))


def linear_weights(n: int) -> list[float]:
    """1, -1/2, 1/3, ...: any fixed coefficients do."""
    return [(-1) ** i / (i + 1) for i in range(n)]


def q_linear_score_curve(spark, sf_dir):
    """ROC / PR points of the fixed linear score."""
    out = evaluate.curve_table(_linear_scored(spark, sf_dir), "label", "score")
    return out.select("threshold", "tp", "fp", "tpr", "fpr", "precision", "recall")


def q_linear_score_auc(spark, sf_dir):
    """Exact rank-sum AUC of the fixed linear score."""
    return evaluate.exact_auc(_linear_scored(spark, sf_dir), "label", "score").select("n_pos", "n_neg", rounded("auc", 9).alias("auc"))


def q_linear_score_bounded_curve(spark, sf_dir):
    """Curve of the fixed linear score in at most 101 points: exact counts and area, and whether the points keep their stated bounds."""
    scored = checkpointed(_linear_scored(spark, sf_dir))
    points, accuracy = 100, 1000
    bounds = evaluate.curve_bounds(evaluate.bounded_curve(scored, points=points, accuracy=accuracy))
    exact = evaluate.exact_auc(scored).withColumnRenamed("auc", "exact")
    rows = F.col("n_pos") + F.col("n_neg")
    # one row each; a join on counts that are literals would be planned as a product
    rest = ["exact", *(c for c in bounds.columns if c not in ("n_pos", "n_neg"))]
    both = exact.unionByName(bounds, allowMissingColumns=True).groupBy("n_pos", "n_neg").agg(F.count(F.lit(1)).alias("_both"), *(F.max(c).alias(c) for c in rest))
    return both.where("_both = 2").select(
        "n_pos",
        "n_neg",
        rounded("exact", 9).alias("auc"),
        (F.col("points") <= points + 1).alias("points_within"),
        (F.col("widest") <= rows * (1 / points + 2 / accuracy) + 1).alias("steps_within"),
        F.col("exact").between(F.col("auc_low") - 1e-12, F.col("auc_high") + 1e-12).alias("area_within"),
    )


def q_linear_score_confusion(spark, sf_dir):
    """Confusion counts of the fixed linear score at the fixed threshold."""
    return evaluate.confusion_at_threshold(_linear_scored(spark, sf_dir), "label", "score")


def q_model_test_counts(spark, sf_dir):
    """Rows and positives of both sides of the split that the classifiers use."""
    return jobs.split_counts(labelled(spark, sf_dir))


def q_yearly_counts(spark, sf_dir):
    """Loans, foreclosures and label classes per file year."""
    lab = jobs.labelled(tables.acquisition_records(spark, sf_dir, with_file_year=True), perf(spark, sf_dir))
    return jobs.yearly_counts(lab)


RERUN_YEAR = 2000


def _year_tables(labelled_loans: DataFrame) -> dict[str, DataFrame]:
    """Five small tables of each file year: counts, label classes, loan purposes, split, confusion of the scorecard."""
    lab = labelled_loans.withColumn("year", F.col("file_year"))
    n, positive = F.count(F.lit(1)).alias("n"), F.sum("is_foreclosed").cast("bigint").alias("n_foreclosed")
    predicted = (credit_risk_score() > F.lit(CONFUSION_THRESHOLD)).cast("int").alias("predicted")
    side = hash_split_column("loan_id", SPLIT_WEIGHTS, seed=SPLIT_SEED).alias("split")
    return {
        "counts": lab.groupBy("year").agg(n, positive),
        "classes": lab.groupBy("year", "is_foreclosed").agg(n),
        "purposes": lab.groupBy("year", "loan_purpose").agg(n, positive),
        "split": lab.groupBy("year", side).agg(n, positive),
        "confusion": lab.groupBy("year", "is_foreclosed", predicted).agg(n),
    }


def q_yearly_tables_rerun(spark, sf_dir):
    """Five tables of every file year, published from the foreclosures reported before 1998, then one year run again
    with all of them: that year is new in all tables, the others are as they were."""
    out = scratch_folder(spark, "results")
    records, reports = tables.acquisition_records(spark, sf_dir, with_file_year=True), perf(spark, sf_dir)
    year = F.get(F.split("reporting_date", "/"), 2).try_cast("int")
    first = checkpointed(jobs.labelled(records, reports.where(year < 1998)))
    years = [r[0] for r in first.select("file_year").distinct().collect()]  # one row a year
    results.publish(spark, _year_tables(first), out, years)
    again = checkpointed(jobs.labelled(records.where(F.col("file_year") == RERUN_YEAR), reports))
    results.publish(spark, _year_tables(again), out, [RERUN_YEAR])

    def rows(name: str) -> DataFrame:
        df = results.read_table(spark, out, name)
        keys = [c for c in df.columns if c not in ("year", "n", "n_foreclosed")]
        value = F.col("n_foreclosed") if "n_foreclosed" in df.columns else F.lit(0)
        item = F.concat_ws("|", *(F.col(c).cast("string") for c in keys)) if keys else F.lit("")
        return df.select(F.lit(name).alias("result"), F.col("year").cast("int").alias("year"), item.alias("item"), "n", value.cast("long").alias("n_foreclosed"))

    out_rows = [rows(name) for name in ("counts", "classes", "purposes", "split", "confusion")]
    return functools.reduce(DataFrame.unionByName, out_rows)


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return jobs.model_metrics(spark, name, _model_predictions(spark, sf_dir, name))

    run.__doc__ = f"Fit {name} on the hash split and report ROC / PR / exact AUC of the test side."
    return run


def _model_predictions(spark, sf_dir, name: str) -> DataFrame:
    md = jobs.model_data(labelled(spark, sf_dir))
    _, pred = jobs.fit_model(name, md.data)
    return pred


def q_logistic_confusion(spark, sf_dir):
    """Confusion counts of the logistic-regression test scores at the fixed threshold."""
    return evaluate.confusion_at_threshold(_model_predictions(spark, sf_dir, "logistic_regression"), "label", "score")


def q_logistic_curve(spark, sf_dir):
    """ROC / PR points of the logistic-regression test scores, one a distinct score."""
    return evaluate.curve_table(_model_predictions(spark, sf_dir, "logistic_regression"), "label", "score")


def q_gbt_curve(spark, sf_dir):
    """ROC / PR points of the gradient-boosted-trees test scores, one a distinct score."""
    return evaluate.curve_table(_model_predictions(spark, sf_dir, "gradient_boosted_trees"), "label", "score")


def q_gbt_confusion(spark, sf_dir):
    """Confusion counts of the gradient-boosted-trees test scores at the fixed threshold."""
    return evaluate.confusion_at_threshold(_model_predictions(spark, sf_dir, "gradient_boosted_trees"), "label", "score")


def q_yearly_report(spark, sf_dir):
    """Everything the per-year runs report, per file year: correlation, GLM tests, the three classifiers'
    metrics, curves and confusion counts, as long rows."""
    records = tables.acquisition_records(spark, sf_dir, with_file_year=True)
    return jobs.yearly_report(spark, records, perf(spark, sf_dir)).rows()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_pipe_records": q_parse_pipe_records,
    "pipe_text_roundtrip": q_pipe_text_roundtrip,
    "landed_performance": q_landed_performance,
    "landing_manifest": q_landing_manifest,
    "reconciled_lines": q_reconciled_lines,
    "foreclosure_extract": q_foreclosure_extract,
    "legacy_foreclosure_ids": q_legacy_foreclosure_ids,
    "latest_entry": q_latest_entry,
    "latest_entry_window": q_latest_entry_window,
    "latest_entry_struct": q_latest_entry_struct,
    "latest_entry_incremental": q_latest_entry_incremental,
    "month_year_parts": q_month_year_parts,
    "year_credit_filter": q_year_credit_filter,
    "engineered_features": q_engineered_features,
    "cast_numeric": q_cast_numeric,
    "blank_to_zero": q_blank_to_zero,
    "drop_na_subset": q_drop_na_subset,
    "first_rows": q_first_rows,
    "label_join": q_label_join,
    "colocated_latest_entry": q_colocated_latest_entry,
    "colocated_label_join": q_colocated_label_join,
    "default_members": q_default_members,
    "non_default_members": q_non_default_members,
    "default_count": q_default_count,
    "default_by_class": q_default_by_class,
    "default_by_year": q_default_by_year,
    "default_by_year_class": q_default_by_year_class,
    "impute_mean": q_impute_mean,
    "impute_mean_plot": q_impute_mean_plot,
    "string_index_freq": q_string_index_freq,
    "label_encode_alpha": q_label_encode_alpha,
    "standardize": q_standardize,
    "correlation_long": q_correlation_long,
    "hash_split": q_hash_split,
    "roc_curve": q_roc_curve,
    "pr_curve": q_pr_curve,
    "exact_auc": q_exact_auc,
    "confusion_at_threshold": q_confusion_at_threshold,
    "scatter_bins": q_scatter_bins,
    "hypothesis_table": q_hypothesis_table,
    "bonferroni": q_bonferroni,
    "glm_moments": q_glm_moments,
    "linear_score_curve": q_linear_score_curve,
    "linear_score_auc": q_linear_score_auc,
    "linear_score_bounded_curve": q_linear_score_bounded_curve,
    "linear_score_confusion": q_linear_score_confusion,
    "model_test_counts": q_model_test_counts,
    "yearly_counts": q_yearly_counts,
    "yearly_tables_rerun": q_yearly_tables_rerun,
    "yearly_correlation": q_yearly_correlation,
    "yearly_hypotheses": q_yearly_hypotheses,
    "yearly_logistic": q_yearly_logistic,
    "yearly_logistic_auc": q_yearly_logistic_auc,
    "yearly_curves": q_yearly_curves,
    "yearly_metrics": q_yearly_metrics,
    "logistic_auc": _model_query("logistic_regression"),
    "forest_auc": _model_query("random_forest"),
    "gbt_auc": _model_query("gradient_boosted_trees"),
    "logistic_confusion": q_logistic_confusion,
    "gbt_confusion": q_gbt_confusion,
    "logistic_curve": q_logistic_curve,
    "gbt_curve": q_gbt_curve,
    "yearly_report": q_yearly_report,
}
