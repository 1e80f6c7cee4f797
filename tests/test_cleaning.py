from loanlens.operators import cleaning
from loanlens.schemas import LOAN_FIELDS, NUMERIC_FEATURES

from conftest import acq_frame, acq_row


def _loans(spark, rows):
    return cleaning.prepare_loans(acq_frame(spark, rows))


def test_month_year_parts(spark):
    df = cleaning.month_year_parts(
        acq_frame(spark, [acq_row(origination_date="12/1999"), acq_row(loan_id="2", origination_date="13-2001"),
                          acq_row(loan_id="3", origination_date="")])
    )
    got = {r["loan_id"]: (r["origination_month"], r["origination_year"]) for r in df.collect()}
    assert got == {"100": (12, 1999), "2": (None, None), "3": (None, None)}
    assert "origination_date" not in df.columns and "unknownCol" not in df.columns


def test_year_and_credit_filter(spark):
    rows = [
        acq_row(loan_id="1", origination_date="12/1999"),
        acq_row(loan_id="2", origination_date="01/2000"),
        acq_row(loan_id="3", borrower_credit_score="", co_borrower_credit_score=""),
        acq_row(loan_id="4", borrower_credit_score="", co_borrower_credit_score="700"),
        acq_row(loan_id="5", origination_date=""),
        acq_row(loan_id="6", origination_date="13-2001"),
    ]
    kept = sorted(r["loan_id"] for r in _loans(spark, rows).collect())
    assert kept == ["2", "4"]


def test_min_credit_score_and_mi(spark):
    rows = [
        acq_row(loan_id="1", borrower_credit_score="", co_borrower_credit_score="700", insurance_percentage=""),
        acq_row(loan_id="2", borrower_credit_score="680", co_borrower_credit_score="680", insurance_percentage="0"),
        acq_row(loan_id="3", borrower_credit_score="650", co_borrower_credit_score="", insurance_percentage="25"),
        acq_row(loan_id="4", borrower_credit_score="700", co_borrower_credit_score="690", insurance_percentage="25.5"),
    ]
    df = _loans(spark, rows)
    assert df.columns == LOAN_FIELDS
    got = {r["loan_id"]: (r["min_credit_score"], r["mi"]) for r in df.collect()}
    assert got == {"1": (700, 0), "2": (680, 0), "3": (650, 1), "4": (690, 0)}


def test_nulls_and_blanks_are_the_same(spark):
    blank = _loans(spark, [acq_row(borrower_credit_score="", insurance_percentage="")]).collect()
    null = _loans(spark, [acq_row(borrower_credit_score=None, insurance_percentage=None)]).collect()
    assert [tuple(r) for r in blank] == [tuple(r) for r in null]


def test_cast_numeric(spark):
    df = cleaning.cast_numeric(_loans(spark, [acq_row(ltv="", dti="abc", original_interest_rate="3.05")]))
    r = df.first()
    assert r["ltv"] is None and r["dti"] is None and r["original_interest_rate"] == 3.05
    types = dict(df.dtypes)
    assert all(types[c] == "double" for c in NUMERIC_FEATURES)


def test_blank_to_zero_and_drop_na(spark):
    parts = cleaning.month_year_parts(acq_frame(spark, [acq_row(ltv="", origination_date="")]))
    r = cleaning.blank_to_zero(parts).first()
    assert r["ltv"] == "0" and r["origination_year"] == 0
    loans = cleaning.cast_numeric(_loans(spark, [acq_row(loan_id="1"), acq_row(loan_id="2", cltv="")]))
    assert [r["loan_id"] for r in cleaning.drop_na_subset(loans).collect()] == ["1"]


def test_foreclosure_extract(spark):
    from loanlens.schemas import PERF_SCHEMA

    perf = spark.createDataFrame(
        [tuple(["1", "01/01/2001"] + [""] * 13 + ["02/01/2001"]), tuple(["2", "01/01/2001"] + [""] * 14),
         tuple(["3", "01/01/2001"] + [""] * 13 + [None])],
        PERF_SCHEMA,
    )
    assert [tuple(r) for r in cleaning.foreclosure_extract(perf).collect()] == [("1", "02/01/2001")]


def test_filters_sit_next_to_the_scan(spark, sf_small):
    from loanlens.sources import acquisition_records

    plan = cleaning.prepare_loans(acquisition_records(spark, sf_small))._jdf.queryExecution().executedPlan().toString()
    # the whole cleaning chain is narrow: no exchange is added on top of the fixture's joins
    assert plan.count("Exchange") <= 4
