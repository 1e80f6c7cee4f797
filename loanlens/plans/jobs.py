"""End-to-end jobs composed from the operators.

* :func:`labelled` -- acquisition + performance -> cleaned, labelled loans.
* :func:`model_data` -- labelled -> model-ready frame, written once to the
  reliable checkpoint folder so the statistics and the three model fits
  read it instead of replaying the joins (and survive executor loss).
* :func:`model_report` -- correlation, hypothesis tests, LR / RF / GBT with
  ROC / PR / confusion tables and a metrics table.
* :func:`yearly_report` -- the same per file year inside one application:
  the year is a grouping key, only the classifier fits are a loop.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.cleaning import cast_numeric, prepare_loans
from loanlens.operators.evaluate import (
    confusion_at_threshold,
    curve_table,
    evaluator_metrics,
    exact_auc,
    probability_score,
)
from loanlens.operators.features import ModelFrame, prepare_model_frame
from loanlens.operators.grouped import (
    GroupStats,
    fit_groups,
    group_confusion,
    group_correlations,
    group_curves,
    group_frame,
    group_histogram,
    group_hypotheses,
    group_metrics,
    group_moments,
    group_totals,
)
from loanlens.operators.labels import foreclosure_ids, label_join
from loanlens.operators.models import MODEL_FITTERS, hash_split, hash_split_column
from loanlens.operators.stats import correlation_long, hypothesis_table
from loanlens.schemas import SPLIT_SEED, SPLIT_WEIGHTS
from loanlens.session import checkpointed, local_rows, scratch_folder
from loanlens.sources.results import year_folder
from loanlens.sources.sinks import METRICS_SCHEMA

MODEL_KEYS = ["loan_id", "origination_year"]


def labelled(acq: DataFrame, perf: DataFrame, min_year: int = 2000) -> DataFrame:
    return label_join(prepare_loans(acq, min_year), foreclosure_ids(perf))


@dataclass
class ModelData:
    frame: ModelFrame
    data: DataFrame  # loan_id, origination_year, out_*, features (scaled), label


def model_data(labelled_loans: DataFrame, fit_on: str = "all") -> ModelData:
    """Prepare features (fitted on all rows or on the training side) and checkpoint the narrow frame."""
    mf = prepare_model_frame(labelled_loans, fit_on=fit_on)
    narrow = mf.df.select(
        *MODEL_KEYS,
        *[f"out_{c}" for c in mf.features],
        F.col("scaledFeatures").alias("features"),
        F.col("is_foreclosed").alias("label"),
    )
    return ModelData(mf, checkpointed(narrow))


def fit_model(name: str, data: DataFrame):
    """Split, fit on train, predict test; returns ``(model, test predictions with score)``.

    The test side is scored once: predictions are written to the checkpoint folder.
    """
    train, test = hash_split(data)
    model = MODEL_FITTERS[name](train, features_col="features", label_col="label")
    pred = model.transform(test).withColumn("score", probability_score())
    return model, checkpointed(pred.select("loan_id", "label", "score", "rawPrediction"))


def model_metrics(spark: SparkSession, name: str, predictions: DataFrame, year: int | None = None) -> DataFrame:
    """``(year, model, metric, value)`` rows: evaluator ROC / PR and the exact rank-sum AUC."""
    with ThreadPoolExecutor(max_workers=2) as pool:  # independent passes over the predictions
        ev_job = pool.submit(evaluator_metrics, predictions)
        auc_job = pool.submit(lambda: exact_auc(predictions, "label", "score").first())
        ev, auc = ev_job.result(), auc_job.result()
    rows = [(year, name, k, float(v)) for k, v in ev.items()]
    rows.append((year, name, "exactAUC", float(auc["auc"]) if auc["auc"] is not None else None))
    rows.append((year, name, "testRows", float(auc["n_pos"] + auc["n_neg"])))
    return local_rows(spark, rows, METRICS_SCHEMA)


@dataclass
class Report:
    correlation: DataFrame
    hypotheses: DataFrame
    metrics: DataFrame
    curves: dict[str, DataFrame]
    confusion: dict[str, DataFrame]


def model_report(
    spark: SparkSession,
    labelled_loans: DataFrame,
    year: int | None = None,
    models: list[str] | None = None,
    fit_on: str = "all",
    concurrent_models: int = 3,
) -> Report:
    md = model_data(labelled_loans, fit_on)
    feats = md.frame.features
    hyp_input = md.data.select(F.col("features").alias("scaledFeatures"), F.col("label").alias("is_foreclosed"))
    names = models or list(MODEL_FITTERS)

    def one_model(name):
        _, pred = fit_model(name, md.data)
        return model_metrics(spark, name, pred, year), curve_table(pred, "label", "score"), confusion_at_threshold(
            pred, "label", "score"
        )

    # correlation, GLM and the classifier fits only read the checkpointed frame: run them as
    # concurrent jobs, keep the results in model order
    with ThreadPoolExecutor(max_workers=max(1, min(concurrent_models, len(names))) + 2) as pool:
        corr_job = pool.submit(correlation_long, md.data, [f"out_{c}" for c in feats])
        hyp_job = pool.submit(hypothesis_table, spark, hyp_input, feats)
        results = list(pool.map(one_model, names))
        corr, hyp = corr_job.result(), hyp_job.result()
    metrics = [m for m, _, _ in results]
    curves = {n: c for n, (_, c, _) in zip(names, results)}
    confusion = {n: k for n, (_, _, k) in zip(names, results)}
    all_metrics = metrics[0]
    for m in metrics[1:]:
        all_metrics = all_metrics.unionByName(m)
    return Report(corr, hyp, all_metrics, curves, confusion)


def split_counts(labelled_loans: DataFrame) -> DataFrame:
    """``(split, n_rows, n_positive)`` of the train / test split."""
    side = hash_split_column("loan_id", SPLIT_WEIGHTS, seed=SPLIT_SEED)
    return labelled_loans.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_foreclosed").cast("bigint").alias("n_positive")
    )


def yearly_counts(labelled_loans: DataFrame, year_col: str = "file_year") -> DataFrame:
    """``(year, n_loans, n_foreclosed, n_classes)`` of every year, those with one label class too."""
    return labelled_loans.groupBy(F.col(year_col).cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum("is_foreclosed").cast("bigint").alias("n_foreclosed"),
        F.countDistinct("is_foreclosed").alias("n_classes"),
    )


@dataclass
class YearlyReport:
    """The full result of each year, every table keyed by ``year``."""

    metrics: DataFrame  # year, model, metric, value
    hypotheses: DataFrame  # year + the hypothesis-table columns
    correlation: DataFrame  # year, feature_a, feature_b, r
    curves: DataFrame  # year, model + the curve-table columns
    confusion: DataFrame  # year, model, label, predicted, n
    years: list[int | None]  # in order

    def tables(self) -> dict[str, DataFrame]:
        """The five tables by name."""
        return {name: getattr(self, name) for name in ("metrics", "hypotheses", "correlation", "curves", "confusion")}

    def rows(self) -> DataFrame:
        """All of it as ``(year, result, model, item, value)``."""
        empty = F.lit(None).cast("string").alias("model")
        item = lambda *cols: F.concat_ws("|", *cols).alias("item")
        long = lambda name, model, what, value: ["year", F.lit(name).alias("result"), model, what, F.col(value).cast("double").alias("value")]
        parts = [
            self.metrics.select(*long("metric", "model", F.col("metric").alias("item"), "value")),
            self.correlation.select(*long("correlation", empty, item("feature_a", "feature_b"), "r")),
            self.confusion.select(*long("confusion", "model", item(F.col("label").cast("string"), F.col("predicted").cast("string")), "n")),
        ]
        for c in ("coefficient", "std_error", "t", "p", "p_bonferroni"):
            parts.append(self.hypotheses.select(*long(c, empty, F.col("feature").alias("item"), c)))
        for c in ("tpr", "fpr", "precision"):
            parts.append(self.curves.select(*long(c, "model", F.col("threshold").cast("string").alias("item"), c)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


PREDICTION_SCHEMA = "loan_id string, label int, score double, year int, model string"
METRICS = ("areaUnderROC", "areaUnderPR", "exactAUC", "testRows")


@dataclass
class YearFrame:
    """The model-ready rows of all years, and what the tests need of them."""

    data: DataFrame  # year, loan_id, origination_year, label, out, z, features
    stats: GroupStats
    moments: DataFrame


def year_frame(labelled_loans: DataFrame, year_col: str = "file_year", fit_on: str = "all") -> YearFrame:
    """Features of every year, fitted on that year's rows (or their training side), in the same few jobs for any number of years."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    rows = cast_numeric(labelled_loans.withColumn("year", F.col(year_col).cast("int")))
    rows = checkpointed(rows.hint("rebalance"))
    stats = fit_groups(rows if fit_on == "all" else rows.where(hash_split_column("loan_id") == "train"), "year")
    # by year, so that a year's fit reads its own folders
    data = checkpointed(group_frame(rows, stats, MODEL_KEYS).hint("rebalance", "year"), partition_by=("year",))
    return YearFrame(data, stats, checkpointed(group_moments(data, stats)))


def _predict(data: DataFrame, year: int | None, model: str, folder: str) -> None:
    """Fit one classifier on one year's training side and write its scores of the test side."""
    train, test = hash_split(data.where(F.col("year").eqNullSafe(F.lit(year))))
    fitted = MODEL_FITTERS[model](train, features_col="features", label_col="label")
    scored = fitted.transform(test).withColumn("score", probability_score())
    scored.select("loan_id", "label", "score").write.parquet(f"{folder}/{year_folder('', year).strip('/')}/model={model}")


def yearly_report(
    spark: SparkSession,
    acq: DataFrame,
    perf: DataFrame | None,
    years: list[int] | None = None,
    models: list[str] | None = None,
    year_col: str = "file_year",
    concurrent_fits: int = 6,
    fit_on: str = "all",
    ids: DataFrame | None = None,
) -> YearlyReport:
    """The report of every year, as tables keyed by ``year``; by default the year in the acquisition file's name.

    Each year has its own feature fit, GLM and classifiers, as a separate per-year run would do, but the year is a
    grouping key: features, correlations, tests, curves, metrics and confusion tables of all years come
    from the same jobs (:mod:`loanlens.operators.grouped`). Only the classifier fits are a job chain for each year and
    model, up to ``concurrent_fits`` at the same time; their test scores go to one table keyed by both.
    A year with a single label class is listed with null metrics and tests, and has no curves or correlations.
    ``ids`` gives the foreclosure ids in place of ``perf``.
    """
    ids = foreclosure_ids(perf) if ids is None else ids
    lab = label_join(prepare_loans(acq), ids)
    if years is not None:
        lab = lab.where(F.col(year_col).isin(years))
    frame = year_frame(lab, year_col, fit_on)
    classes = frame.moments.select("year", (F.col("vy") > 0).alias("two")).orderBy("year").collect()  # one row a year
    names = models or list(MODEL_FITTERS)
    folder = scratch_folder(spark, "predictions")
    with ThreadPoolExecutor(max_workers=max(1, concurrent_fits)) as pool:
        list(pool.map(lambda fit: _predict(frame.data, *fit, folder), [(r["year"], m) for r in classes if r["two"] for m in names]))
    if any(r["two"] for r in classes):
        predictions = spark.read.schema(PREDICTION_SCHEMA).parquet(folder)
    else:
        predictions = spark.createDataFrame([], PREDICTION_SCHEMA)
    keys = ["year", "model"]
    totals = checkpointed(group_totals(checkpointed(group_histogram(predictions, keys)), keys))
    # every year and model has its metrics, null where there is nothing to score
    wanted = local_rows(spark, [(r["year"], m, k) for r in classes for m in names for k in METRICS], "_year int, _model string, _metric string")
    found = group_metrics(totals, keys)
    same = wanted["_year"].eqNullSafe(found["year"]) & (wanted["_model"] == found["model"]) & (wanted["_metric"] == found["metric"])
    metrics = wanted.join(found, same, "left").select(F.col("_year").alias("year"), F.col("_model").alias("model"), F.col("_metric").alias("metric"), "value")
    tested = frame.moments.where("vy > 0")
    return YearlyReport(
        metrics,
        group_hypotheses(frame.moments, frame.stats),
        group_correlations(tested, frame.stats),
        group_curves(totals, keys),
        group_confusion(predictions, keys),
        [r["year"] for r in classes],
    )
