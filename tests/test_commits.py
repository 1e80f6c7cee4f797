"""Staged commits, yearly result tables, the landing manifest and reconciled reads."""

import os

import pytest
from conftest import acq_row
from pyspark.sql import functions as F

from loanlens.plans import cli
from loanlens.schemas import ACQ_FIELDS, PERF_FIELDS, perf_fields
from loanlens.sources import (
    acquisition_records,
    check_landing,
    commit,
    land_acquisition,
    land_performance,
    manifest,
    performance_records,
    publish,
    read_acquisition,
    read_landed,
    read_reconciled,
    read_table,
    write_pipe_text,
)

TABLES = ("a", "b", "nested/c")


def run_tables(spark, years, value, skip=()):
    """Tables that hold one row a year (none for the ones in ``skip``)."""
    return {
        t: spark.createDataFrame([(y, t, value) for y in years if (t, y) not in skip], "year int, name string, value string") for t in TABLES
    }


def state(spark, out):
    return {t: sorted((r.year, r.value) for r in read_table(spark, out, t, "year int, name string, value string").collect()) for t in TABLES}


def test_a_rerun_replaces_its_year_only(spark, tmp_path):
    out = str(tmp_path / "out")
    publish(spark, run_tables(spark, [2004, 2005, 2006], "old"), out, [2004, 2005, 2006])
    publish(spark, run_tables(spark, [2005, 2006], "new"), out, [2005])  # rows of 2006 are not this run's
    assert state(spark, out) == dict.fromkeys(TABLES, [(2004, "old"), (2005, "new"), (2006, "old")])
    publish(spark, run_tables(spark, [2004], "newer", skip={("b", 2004)}), out, [2004])
    assert state(spark, out)["a"] == [(2004, "newer"), (2005, "new"), (2006, "old")]
    assert state(spark, out)["b"] == [(2005, "new"), (2006, "old")]
    assert not os.path.exists(f"{out}/_commit.json") and os.listdir(f"{out}/_staged") == []
    assert read_table(spark, out, "none", "year int, x int").count() == 0


def test_a_null_year_is_a_year_of_its_own(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(None, "old"), (2001, "old")], "year int, value string")
    publish(spark, {"t": rows}, out, [None, 2001])
    publish(spark, {"t": rows.withColumn("value", F.lit("new"))}, out, [None])
    assert sorted((r.year or 0, r.value) for r in read_table(spark, out, "t").collect()) == [(0, "new"), (2001, "old")]


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_a_crash_while_publishing_is_finished_by_the_next(spark, tmp_path, monkeypatch, moves):
    out = str(tmp_path / "out")
    publish(spark, run_tables(spark, [2004, 2005], "old"), out, [2004, 2005])
    move, done = commit.Folder.move, []

    def dies(self, src, dst):
        if not dst.endswith(commit.RECORD):
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(dst)
        move(self, src, dst)

    with monkeypatch.context() as m:
        m.setattr(commit.Folder, "move", dies)
        try:
            publish(spark, run_tables(spark, [2005], "new"), out, [2005])
        except KeyboardInterrupt:
            assert moves < 3 and os.path.exists(f"{out}/_commit.json")
    assert state(spark, out) == dict.fromkeys(TABLES, [(2004, "old"), (2005, "new")])
    assert not commit.recover(spark, out)


def test_a_crash_between_two_tables_before_the_commit_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    publish(spark, run_tables(spark, [2004, 2005], "old"), out, [2004, 2005])
    broken = run_tables(spark, [2005], "new")
    broken["b"] = broken["b"].withColumn("value", F.raise_error(F.lit("died")))
    with pytest.raises(Exception, match="died"):
        publish(spark, broken, out, [2005])
    assert state(spark, out) == dict.fromkeys(TABLES, [(2004, "old"), (2005, "old")])
    publish(spark, run_tables(spark, [2005], "new"), out, [2005])
    assert state(spark, out) == dict.fromkeys(TABLES, [(2004, "old"), (2005, "new")])


def test_two_commits_do_not_mix(spark, tmp_path):
    out = str(tmp_path / "out")
    one, other = commit.StagedWrite(spark, out), commit.StagedWrite(spark, out)
    for write, value in ((one, "1"), (other, "2")):
        spark.createDataFrame([(value,)], "v string").write.parquet(write.folder("t"))
    one.commit(["t"])
    other.commit(["t"])
    assert [r.v for r in spark.read.parquet(f"{out}/t").collect()] == ["2"]


def test_cli_rerun_of_one_year_keeps_the_others(spark, sf_small, tmp_path):
    acq = acquisition_records(spark, sf_small, with_file_year=True)
    for y in (2000, 2001):
        write_pipe_text(acq.where(F.col("file_year") == y).select(*ACQ_FIELDS), str(tmp_path / f"Acquisition_{y}"))
    perf_dir, out = str(tmp_path / "perf"), str(tmp_path / "out")
    write_pipe_text(performance_records(spark, sf_small).select(*PERF_FIELDS), perf_dir)
    args = ["report", "--acq", str(tmp_path / "Acquisition_*"), "--perf", perf_dir, "--out", out, "--by-year", "--models", "logistic_regression"]
    cli.main(args)
    names = ("metrics", "hypotheses", "correlation", "curves", "confusion")
    before = {n: sorted(map(str, read_table(spark, out, n).collect())) for n in names}
    cli.main([*args, "--year", "2001"])
    after = {n: sorted(map(str, read_table(spark, out, n).collect())) for n in names}
    assert before == after and all("year=2000" in str(before[n]) and "year=2001" in str(before[n]) for n in names)


# ---- landing ---------------------------------------------------------------------


def perf_file(path, loans, year=2000):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join("|".join([str(i), f"01/01/{year}"] + [f"v{k}" for k in range(2, 16)]) + "\n" for i in loans))
    return str(path)


def test_a_changed_file_and_a_leftover_folder_are_landed_again(spark, tmp_path):
    dst = str(tmp_path / "landed")
    a, b = perf_file(tmp_path / "in/a.txt", range(10)), perf_file(tmp_path / "in/b.txt", range(5), 2001)
    # what a job that died before its commit may have left of b: some rows without a manifest row
    from loanlens.sources.landing import SOURCE_FILE, reporting_year, source_key
    from loanlens.sources.text import read_performance

    half = read_performance(spark, b).withColumns({"reporting_year": reporting_year(), SOURCE_FILE: source_key()}).where("loan_id < 2")
    half.write.partitionBy(SOURCE_FILE, "reporting_year").parquet(dst)
    assert land_performance(spark, a, dst).count() == 10  # the leftover is not part of the table
    assert land_performance(spark, [a, b], dst).count() == 15
    assert {(r.path.rsplit("/", 1)[1], r.rows) for r in manifest(spark, dst).collect()} == {("a.txt", 10), ("b.txt", 5)}
    perf_file(tmp_path / "in/a.txt", range(15))  # the same path, more lines
    assert land_performance(spark, [a, b], dst).count() == 20
    perf_file(tmp_path / "in/a.txt", range(100, 115))  # as many bytes or not, another time
    os.utime(a, (1, 1))
    landed = land_performance(spark, [a, b], dst)
    assert landed.count() == 20 and landed.where("loan_id = 114").count() == 1
    assert all(r.ok for r in check_landing(spark, dst).collect())
    runs = manifest(spark, dst).select("run").distinct().count()
    land_performance(spark, [a, b], dst)
    assert runs == manifest(spark, dst).select("run").distinct().count() == 2


def test_a_landing_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    dst = str(tmp_path / "landed")
    a, b = perf_file(tmp_path / "in/a.txt", range(10)), perf_file(tmp_path / "in/b.txt", range(5), 2001)
    land_performance(spark, a, dst)
    with monkeypatch.context() as m:
        m.setattr(commit.StagedWrite, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            land_performance(spark, [a, b], dst)
    assert read_landed(spark, dst).count() == spark.read.parquet(dst).count() == 10
    assert land_performance(spark, [a, b], dst).count() == 15


def test_check_landing_sees_lost_and_changed_rows(spark, tmp_path):
    import glob

    dst = str(tmp_path / "landed")
    land_performance(spark, [perf_file(tmp_path / "in/a.txt", range(10)), perf_file(tmp_path / "in/b.txt", range(5))], dst)
    (tmp_path / "in/empty.txt").write_text("\n\n")
    assert land_performance(spark, str(tmp_path / "in/empty.txt"), str(tmp_path / "nothing")).count() == 0
    land_performance(spark, str(tmp_path / "in"), dst)
    files = check_landing(spark, dst).collect()
    assert len(files) == 3 and all(r.ok for r in files)
    for f in glob.glob(f"{dst}/source_file=b.txt*/*/*.parquet"):
        os.remove(f)
    assert {r.source_file[:1]: (r.rows, r.found_rows, r.ok) for r in check_landing(spark, dst).collect()} == {
        "a": (10, 10, True), "b": (5, 0, False), "e": (0, 0, True),
    }


def test_file_names_with_odd_characters_are_landed(spark, tmp_path):
    dst = str(tmp_path / "landed")
    odd = [perf_file(tmp_path / "in" / n, range(3)) for n in ("a b.txt", "c[1]{x}.txt", "d=e%20.txt")]
    assert land_performance(spark, str(tmp_path / "in"), dst).count() == 9
    perf_file(tmp_path / "in/c[1]{x}.txt", range(8))
    assert land_performance(spark, str(tmp_path / "in"), dst).count() == 14
    assert len(odd) == manifest(spark, dst).count() == 3


# ---- lines accounted for ------------------------------------------------------------


def test_wide_acquisition_lines_stop_the_read(spark, tmp_path):
    path = tmp_path / "Acquisition_2001.txt"
    path.write_text("|".join(acq_row(loan_id="7")) + "\n" + "|".join(acq_row(loan_id="8")) + "|x|y\n")
    with pytest.raises(Exception, match="loan 8 has an acquisition line of more than 26 fields"):
        read_acquisition(spark, str(path)).select("loan_id").collect()
    with pytest.raises(Exception, match="more than 26 fields"):
        land_acquisition(spark, str(path), str(tmp_path / "landed"))
    path.write_text("|".join(acq_row(loan_id="7")) + "\n8|R\n")
    assert [(r.loan_id, r.zip, r.file_year) for r in read_acquisition(spark, str(path)).orderBy("loan_id").collect()] == [("7", "940", 2001), ("8", None, 2001)]


def test_every_line_is_accounted_for(spark, tmp_path):
    lines = [["1", "a", "b"], ["2", "a"], ["3", "a", "b", "c"], ["4", "", ""], ["5", "x", "y"], ["6"]]
    (tmp_path / "in.txt").write_text("".join("|".join(f) + "\n" for f in lines) + "\n\n")
    read = read_reconciled(spark, str(tmp_path / "in.txt"), ["id", "x", "y"])
    assert read.counts == {"lines": 6, "good": 3, "short": 2, "wide": 1, "rows": 3, "rejected": 3}
    assert sorted(map(tuple, read.rows.collect())) == [("1", "a", "b"), ("4", None, None), ("5", "x", "y")]
    assert sorted(map(tuple, read.rejected.collect())) == [("short", "2|a"), ("short", "6"), ("wide", "3|a|b|c")]
    kept = read_reconciled(spark, str(tmp_path / "in.txt"), ["id", "x", "y"], keep_short=True)
    assert kept.counts["rows"] == 5 and kept.counts["rejected"] == 1
    assert ("2", "a", None) in set(map(tuple, kept.rows.collect()))
    (tmp_path / "none.txt").write_text("")
    assert read_reconciled(spark, str(tmp_path / "none.txt"), perf_fields()).counts["lines"] == 0
