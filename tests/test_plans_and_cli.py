import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from loanlens.operators.features import prepare_model_frame
from loanlens.operators.models import hash_split_column
from loanlens.plans import cli
from loanlens.plans.jobs import labelled
from loanlens.schemas import ACQ_FIELDS, MODEL_FEATURES, PERF_FIELDS
from loanlens.sources import acquisition_records, performance_records, to_pandas_bounded, write_metrics, write_pipe_text

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def test_no_cartesian_or_python_in_any_sql_query(spark, sf_small):
    q = E.queries()
    for name in E.oracle_sql():
        plan = q[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_scan_reads_only_needed_columns(spark, sf_small):
    plan = E.queries()["hash_split"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_discount" not in plan


def test_fit_on_train_uses_train_rows_only(spark, sf_small):
    lab = labelled(acquisition_records(spark, sf_small), performance_records(spark, sf_small))
    mf = prepare_model_frame(lab, fit_on="train")
    train = mf.df.where(hash_split_column("loan_id") == "train")
    for c in ("ltv", "dti", "original_interest_rate"):
        m = train.agg(F.avg(c)).first()[0]
        assert abs(mf.moments.columns[c].mean - m) < 1e-9
    assert mf.moments.columns["ltv"].n == train.count() < mf.df.count()
    assert mf.features == MODEL_FEATURES


def test_bounded_pandas_and_metrics_sink(spark, tmp_path):
    df = spark.range(10)
    assert len(to_pandas_bounded(df, 10)) == 10
    with pytest.raises(ValueError):
        to_pandas_bounded(df, 9)
    m = spark.createDataFrame([(2001, "lr", "auc", 0.7), (2002, "lr", "auc", 0.6)], "year int, model string, metric string, value double")
    write_metrics(m, str(tmp_path / "metrics"))
    assert sorted(os.listdir(tmp_path / "metrics"))[:2] == ["_SUCCESS", "year=2001"] or "year=2001" in os.listdir(tmp_path / "metrics")
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2


def test_cli_end_to_end(spark, sf_small, tmp_path):
    acq_dir, perf_dir = str(tmp_path / "acq"), str(tmp_path / "perf")
    write_pipe_text(acquisition_records(spark, sf_small).select(*ACQ_FIELDS), acq_dir)
    write_pipe_text(performance_records(spark, sf_small).select(*PERF_FIELDS), perf_dir)
    out = tmp_path / "out"
    cli.main(["foreclosures", "--perf", perf_dir, "--out", str(out / "fc")])
    cli.main(["latest", "--perf", perf_dir, "--out", str(out / "latest")])
    cli.main(["foreclosures", "--perf", perf_dir, "--out", str(out / "legacy"), "--legacy-text"])
    from loanlens.sources import read_legacy_foreclosures

    assert read_legacy_foreclosures(spark, str(out / "legacy")).where("f_loan_id IS NOT NULL").count() == 220
    cli.main(["scatter", "--acq", acq_dir, "--out", str(out / "scatter")])
    cli.main(["report", "--acq", acq_dir, "--foreclosures", str(out / "fc"), "--out", str(out / "report"),
              "--year", "2000", "--models", "logistic_regression", "--legacy-output"])
    pv = [r["value"] for r in spark.read.text(str(out / "report" / "pval")).collect()]
    assert len(pv) == 23 and all(0.0 <= float(v) <= 1.0 for v in pv)
    assert len(spark.read.text(str(out / "report" / "logisticRegression")).collect()) == 1
    assert not (out / "report" / "randomForest").exists()
    assert spark.read.parquet(str(out / "fc")).count() == 220
    assert spark.read.parquet(str(out / "latest")).count() == 1473
    assert spark.read.parquet(str(out / "scatter")).agg(F.sum("n")).first()[0] == 1500
    metrics = spark.read.parquet(str(out / "report" / "metrics"))
    assert {r["metric"] for r in metrics.collect()} >= {"areaUnderROC", "areaUnderPR", "exactAUC"}
    assert spark.read.parquet(str(out / "report" / "hypotheses")).count() == 23
    assert spark.read.parquet(str(out / "report" / "correlation")).count() == 231


def test_cli_by_file_year(spark, sf_small, tmp_path):
    acq = acquisition_records(spark, sf_small, with_file_year=True)
    for y in (2000, 2001):
        write_pipe_text(acq.where(F.col("file_year") == y).select(*ACQ_FIELDS), str(tmp_path / f"Acquisition_{y}"))
    perf_dir = str(tmp_path / "perf")
    write_pipe_text(performance_records(spark, sf_small).select(*PERF_FIELDS), perf_dir)
    out = tmp_path / "yearly"
    cli.main(["report", "--acq", str(tmp_path / "Acquisition_*"), "--perf", perf_dir, "--out", str(out),
              "--by-year", "--models", "logistic_regression"])
    metrics = spark.read.parquet(str(out / "metrics"))
    assert {r["year"] for r in metrics.collect()} == {2000, 2001}
    hyp = spark.read.parquet(str(out / "hypotheses"))
    assert hyp.count() == 2 * 23


def test_cli_by_file_year_with_a_list_and_legacy_output(spark, sf_small, tmp_path):
    acq = acquisition_records(spark, sf_small, with_file_year=True)
    write_pipe_text(acq.where(F.col("file_year") == 2000).select(*ACQ_FIELDS), str(tmp_path / "Acquisition_2000"))
    perf_dir = str(tmp_path / "perf")
    write_pipe_text(performance_records(spark, sf_small).select(*PERF_FIELDS), perf_dir)
    cli.main(["foreclosures", "--perf", perf_dir, "--out", str(tmp_path / "fc")])
    out = tmp_path / "yearly"
    cli.main(["report", "--acq", str(tmp_path / "Acquisition_*"), "--foreclosures", str(tmp_path / "fc"), "--out", str(out),
              "--by-year", "--models", "logistic_regression", "--fit-on", "train", "--legacy-output"])
    assert len(spark.read.text(str(out / "2000" / "pval")).collect()) == 23
    assert len(spark.read.text(str(out / "2000" / "logisticRegression")).collect()) == 1
    conf = spark.read.parquet(str(out / "confusion"))
    assert conf.count() == 4 and {r["year"] for r in conf.collect()} == {2000}
    assert spark.read.parquet(str(out / "correlation")).count() == 231
    assert spark.read.parquet(str(out / "curves")).count() > 5


def test_cli_keeps_all_performance_fields(spark, tmp_path):
    lines = ["|".join([str(i % 5), f"0{1 + i // 5}/01/2000"] + [f"v{i}_{k}" for k in range(2, 31)]) for i in range(15)]
    (tmp_path / "perf.txt").write_text("\n".join(lines) + "\n")
    out = tmp_path / "landed"
    cli.main(["--perf-fields", "31", "land", "--perf", str(tmp_path / "perf.txt"), "--out", str(out)])
    cli.main(["--perf-fields", "31", "latest", "--perf", str(tmp_path / "perf.txt"), "--out", str(tmp_path / "a")])
    cli.main(["--input-format", "parquet", "latest", "--perf", str(out / "performance"), "--out", str(tmp_path / "b")])
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    assert len(a.columns) == 31 and a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.where("loan_id = 3").first()["field_30"] == "v13_30"


def test_yearly_report_reads_one_years_folders(spark, sf_small):
    from loanlens.session import checkpointed

    acq = acquisition_records(spark, sf_small, with_file_year=True)
    lab = checkpointed(labelled(acq, performance_records(spark, sf_small)), partition_by=("file_year",))
    plan = lab.where(F.col("file_year").eqNullSafe(F.lit(2000)))._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "2000" in filters.split("PartitionFilters: [")[1].split("]")[0]


def test_yearly_report_lists_years_with_one_class(spark, sf_small):
    from loanlens.plans.jobs import yearly_report

    acq = acquisition_records(spark, sf_small, with_file_year=True)
    acq = acq.where("file_year = 2000").unionByName(acq.where("file_year = 2001").limit(0))
    none = performance_records(spark, sf_small).where("false")
    rep = yearly_report(spark, acq, none, models=["logistic_regression"])
    metrics = rep.metrics.collect()
    assert {r["year"] for r in metrics} == {2000} and all(r["value"] is None for r in metrics) and len(metrics) == 4
    hyp = rep.hypotheses.collect()
    assert len(hyp) == 23 and all(r["coefficient"] == 0 and r["p"] is None for r in hyp)
    assert rep.correlation.count() == rep.curves.count() == rep.confusion.count() == 0
    assert rep.rows().count() == 4 + 5 * 23


def test_release_checkpoints(spark):
    from loanlens.session import checkpointed, release_checkpoints

    release_checkpoints(spark)
    df = checkpointed(spark.range(5))
    assert df.count() == 5
    assert release_checkpoints(spark) == 1


def test_cli_latest_with_prior(spark, sf_small, tmp_path):
    from loanlens.operators.labels import latest_entry

    perf = performance_records(spark, sf_small)
    early, late = str(tmp_path / "early"), str(tmp_path / "late")
    write_pipe_text(perf.where("substr(reporting_date, 7, 4) < '1998'"), early)
    write_pipe_text(perf.where("substr(reporting_date, 7, 4) >= '1998'"), late)
    cli.main(["latest", "--perf", early, "--out", str(tmp_path / "l1")])
    cli.main(["latest", "--perf", late, "--prior", str(tmp_path / "l1"), "--out", str(tmp_path / "l2")])
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "l2")).collect())
    from loanlens.sources import read_performance

    full = read_performance(spark, [early, late])
    assert got == sorted(tuple(r) for r in latest_entry(full).collect())


def test_cli_argument_errors():
    with pytest.raises(SystemExit):
        cli.main(["report", "--acq", "x", "--out", "y"])  # neither --perf nor --foreclosures
    with pytest.raises(SystemExit):
        cli.main(["nonsense"])
