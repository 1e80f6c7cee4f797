"""Tables bucketed by loan: the same rows as the shuffled forms, without an exchange."""

import pytest
from conftest import acq_frame, acq_row

from loanlens.operators.cleaning import prepare_loans
from loanlens.operators.labels import foreclosure_ids, label_join, label_join_colocated, latest_entry
from loanlens.schemas import PERF_FIELDS
from loanlens.sources.colocated import read_colocated, write_colocated


def perf_frame(spark, rows):
    """``(loan id, date, foreclosure date)`` records."""
    return spark.createDataFrame([(i, d, *[str(k)] * 13, f) for k, (i, d, f) in enumerate(rows)], ", ".join(f"{c} string" for c in PERF_FIELDS))


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def data(spark):
    ids = [str(i) for i in range(300)] + ["", None, "x1", "x1", " 7 ", "-3"]
    loans = acq_frame(spark, [acq_row(loan_id=i) for i in ids])
    perf = perf_frame(
        spark,
        [(i, f"{1 + k % 12:02d}/01/{2000 + k % 5}", "03/01/2004" if k % 7 == 0 else "") for k, i in enumerate(ids * 3)]
        + [("5", "01/01/2010", "")] * 40 + [(None, "01/01/2011", "02/01/2011"), ("x1", "bad date", "02/01/2011")],
    )
    return loans, perf


def test_same_rows_without_an_exchange(spark, data, tmp_path):
    loans, perf = data
    loans_at, perf_at = write_colocated(loans, str(tmp_path / "l"), 8), write_colocated(perf, str(tmp_path / "p"), 8)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        latest = latest_entry(perf_at)
        joined = label_join_colocated(prepare_loans(loans_at), perf_at)
        assert "Exchange" not in plan(joined)
        # the only exchange is the one of records without an integer id, after they were reduced where they lie
        first, second = plan(latest).split("EqualTo(loan_spread,0)")
        assert "Exchange" not in first and second.count("Exchange") == 1
        assert "(loan_spread#" in second[second.index("Exchange") :] and " > 0)" in second[second.index("Exchange") :]
        assert "Exchange hashpartitioning" in plan(latest_entry(perf))
        assert rows(latest) == rows(latest_entry(perf)) and latest.columns == perf.columns
        expected = label_join(prepare_loans(loans), foreclosure_ids(perf))
        assert joined.columns == expected.columns and rows(joined) == rows(expected)
        assert joined.where("is_foreclosed = 1").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_a_table_is_opened_again_from_its_path(spark, data, tmp_path):
    _, perf = data
    path = str(tmp_path / "it's p")
    written = write_colocated(perf, path, 4)
    again = read_colocated(spark, path)
    assert rows(again) == rows(written) and again.schema == written.schema
    assert plan(latest_entry(again)).count("Exchange") == 1
    assert rows(again.drop("loan_key", "loan_spread")) == rows(perf)
