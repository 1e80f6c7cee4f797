import os

import pytest
from pyspark.sql import functions as F

from loanlens.schemas import ACQ_FIELDS, PERF_FIELDS, perf_fields
from loanlens.sources import (
    acquisition_records,
    format_legacy_foreclosures,
    parse_legacy_foreclosures,
    parse_pipe_lines,
    performance_records,
    read_acquisition,
    read_legacy_foreclosures,
    read_performance,
    read_pipe_text,
    to_pipe_lines,
    write_pipe_text,
)
from loanlens.sources.text import CORRUPT_COLUMN


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fixture_counts(spark, sf_small):
    acq = acquisition_records(spark, sf_small)
    perf = performance_records(spark, sf_small)
    assert acq.columns == ACQ_FIELDS
    assert perf.columns == PERF_FIELDS
    assert acq.count() == 1500
    assert acq.select("loan_id").distinct().count() == 1500
    assert perf.count() == 6000
    assert perf.where("foreclosure_date <> ''").count() == 220


def test_bzip2_round_trip(spark, sf_small, tmp_path):
    acq = acquisition_records(spark, sf_small)
    out = str(tmp_path / "acq")
    write_pipe_text(acq.select(*ACQ_FIELDS[:-1]), out, compression="bzip2")
    assert any(f.endswith(".bz2") for f in os.listdir(out))
    back = read_pipe_text(spark, out, ACQ_FIELDS[:-1])
    expected = acq.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in ACQ_FIELDS[:-1]])
    assert _rows(back) == _rows(expected)


def test_parse_lines_equals_file_read(spark, sf_small, tmp_path):
    perf = performance_records(spark, sf_small).limit(300)
    lines = to_pipe_lines(perf, PERF_FIELDS)
    path = str(tmp_path / "perf_text")
    lines.write.text(path)
    from_file = read_performance(spark, path)
    from_lines = parse_pipe_lines(spark.read.text(path), PERF_FIELDS)
    assert _rows(from_file) == _rows(from_lines)


def test_short_and_long_lines_reported(spark, tmp_path):
    path = tmp_path / "odd.txt"
    path.write_text("1|a|b\n2|a\n3|a|b|c|d\n")
    df = read_pipe_text(spark, str(path), ["id", "x", "y"], keep_corrupt=True)
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"][CORRUPT_COLUMN] is None
    assert rows["2"]["y"] is None and rows["2"][CORRUPT_COLUMN] == "2|a"
    assert rows["3"]["y"] == "b" and rows["3"][CORRUPT_COLUMN] == "3|a|b|c|d"


def test_file_year_from_name(spark, tmp_path):
    d = tmp_path / "acq"
    d.mkdir()
    line = "|".join(["7"] + [""] * 25) + "\n"
    (d / "Acquisition_2005Q1.txt").write_text(line)
    (d / "Acquisition2003Q4.txt").write_text(line.replace("7", "8", 1))
    df = read_acquisition(spark, str(d))
    got = {r["loan_id"]: r["file_year"] for r in df.select("loan_id", "file_year").collect()}
    assert got == {"7": 2005, "8": 2003}


def test_legacy_tuple_lines(spark):
    lines = spark.createDataFrame(
        [("('123', '02/01/2001')",), ("( '45' ,'03/01/2002' )",), ("('abc', '01/01/2000')",), ("garbage",),
         ("(77, '04/01/2003')",)],
        "value string",
    )
    got = [tuple(r) for r in parse_legacy_foreclosures(lines).collect()]
    assert got == [(123, "02/01/2001"), (45, "03/01/2002"), (None, "01/01/2000"), (None, None), (77, "04/01/2003")]


def test_legacy_round_trip(spark, sf_small, tmp_path):
    from loanlens.operators.cleaning import foreclosure_extract

    ext = foreclosure_extract(performance_records(spark, sf_small))
    path = str(tmp_path / "legacy")
    format_legacy_foreclosures(ext).write.text(path)
    back = read_legacy_foreclosures(spark, path)
    expected = ext.select(F.col("loan_id").cast("bigint").alias("f_loan_id"), "foreclosure_date")
    assert _rows(back) == _rows(expected)


def test_landing_to_parquet(spark, sf_small, tmp_path):
    from loanlens.operators.cleaning import foreclosure_extract
    from loanlens.sources import land_acquisition, land_performance

    acq = acquisition_records(spark, sf_small, with_file_year=True)
    for y in (1999, 2000):
        write_pipe_text(acq.where(F.col("file_year") == y).select(*ACQ_FIELDS), str(tmp_path / f"Acquisition_{y}"))
    perf = performance_records(spark, sf_small)
    write_pipe_text(perf, str(tmp_path / "perf"))
    la = land_acquisition(spark, str(tmp_path / "Acquisition_*"), str(tmp_path / "landed_acq"))
    lp = land_performance(spark, str(tmp_path / "perf"), str(tmp_path / "landed_perf"))
    assert sorted(r["file_year"] for r in la.select("file_year").distinct().collect()) == [1999, 2000]
    assert lp.count() == 6000
    # landed records give the same operator results as the raw ones
    a = sorted(tuple(r) for r in foreclosure_extract(lp).collect())
    b = sorted(tuple(r) for r in foreclosure_extract(perf).collect())
    assert a == b
    plan = foreclosure_extract(lp)._jdf.queryExecution().executedPlan().toString()
    assert "field_06" not in plan  # only the referenced columns are read


def _perf_text(path, n_fields, loans, month="01", year=2000):
    path.mkdir(parents=True, exist_ok=True)
    lines = []
    for i in loans:
        f = [str(i), f"{month}/01/{year}"] + [f"v{k}" for k in range(2, n_fields)]
        lines.append("|".join(f))
    (path / f"perf_{month}_{year}.txt").write_text("\n".join(lines) + "\n")
    return str(path / f"perf_{month}_{year}.txt")


def test_landing_adds_files_of_a_year_and_skips_those_it_has(spark, sf_small, tmp_path):
    from loanlens.sources import land_acquisition, land_performance

    acq = acquisition_records(spark, sf_small).select(*ACQ_FIELDS)
    for q in (1, 2):
        write_pipe_text(acq.where(f"cast(loan_id as bigint) % 2 = {q - 1}"), str(tmp_path / f"Acquisition_2000Q{q}"))
    dst = str(tmp_path / "acq")
    first = land_acquisition(spark, str(tmp_path / "Acquisition_2000Q1"), dst).count()
    assert land_acquisition(spark, str(tmp_path / "Acquisition_2000Q2"), dst).count() == acq.count() > first
    assert land_acquisition(spark, str(tmp_path / "Acquisition_2000*"), dst).count() == acq.count()
    dst = str(tmp_path / "perf_landed")
    jan, feb = _perf_text(tmp_path / "p", 31, range(100), "01"), _perf_text(tmp_path / "p", 31, range(60), "02")
    land_performance(spark, jan, dst, perf_fields(31))
    assert land_performance(spark, feb, dst, perf_fields(31)).count() == 160
    assert land_performance(spark, [jan, feb], dst, perf_fields(31)).count() == 160
    _perf_text(tmp_path / "p", 31, range(70), "02", 2000)  # the file was delivered again, longer
    assert land_performance(spark, feb, dst, perf_fields(31), replace=True).count() == 170
    other = _perf_text(tmp_path / "elsewhere", 31, range(5), "02")  # the same name in another folder
    assert land_performance(spark, other, dst, perf_fields(31)).count() == 175


def test_landing_keeps_all_fields_and_refuses_wider_lines(spark, tmp_path):
    from loanlens.sources import land_performance, read_performance

    path = _perf_text(tmp_path / "p", 31, range(10))
    landed = land_performance(spark, path, str(tmp_path / "out"), perf_fields(31))
    assert [c for c in perf_fields(31) if c not in landed.columns] == []
    assert landed.where("loan_id = 3").first()["field_30"] == "v30"
    with pytest.raises(Exception, match="of more than 16 fields"):
        read_performance(spark, path).count()
    short = tmp_path / "short.txt"
    short.write_text("7|01/01/2001\n")
    assert read_performance(spark, str(short)).first()["loan_id"] == "7"


def test_landed_files_do_not_grow_with_tasks_times_years(spark, tmp_path):
    import glob

    from loanlens.sources import land_performance

    (tmp_path / "p").mkdir()
    for k in range(6):  # every file has records of four years
        lines = ["|".join([str(i), f"01/01/{2000 + i % 4}"] + [""] * 14) for i in range(400)]
        (tmp_path / "p" / f"f{k}.txt").write_text("\n".join(lines) + "\n")
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # many tasks a file
    try:
        landed = land_performance(spark, str(tmp_path / "p"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    files = glob.glob(str(tmp_path / "out/*/*/*.parquet"))
    assert landed.count() == 2400 and len(files) <= 6 * 4 * 2
    import pyarrow.parquet as pq

    for f in files:
        ids = pq.read_table(f, columns=["loan_id"]).column("loan_id").to_pylist()
        assert ids == sorted(ids)


def test_rebalance_splits_a_large_year(spark, tmp_path):
    import glob

    from loanlens.sources import land_performance

    (tmp_path / "p").mkdir()
    lines = ["|".join([str(i), "01/01/2000"] + [f"{i * 7919 % 100003}"] * 14) for i in range(20_000)]
    (tmp_path / "p" / "f.txt").write_text("\n".join(lines) + "\n")
    settings = {"spark.sql.files.maxPartitionBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        land_performance(spark, str(tmp_path / "p"), str(tmp_path / "out"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert 3 <= len(glob.glob(str(tmp_path / "out/*/*/*.parquet"))) <= 40  # no year in one task


def test_read_acquisition_without_file_year(spark, tmp_path):
    d = tmp_path / "a"
    d.mkdir()
    (d / "Acquisition_2004.txt").write_text("|".join(["9"] + [""] * 25) + "\n")
    df = read_acquisition(spark, str(d), with_file_year=False)
    assert df.columns == ACQ_FIELDS and df.first()["loan_id"] == "9"
