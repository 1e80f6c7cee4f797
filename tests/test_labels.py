from loanlens.operators import labels
from loanlens.schemas import PERF_SCHEMA
from loanlens.sources import acquisition_records, performance_records
from loanlens.operators.cleaning import prepare_loans


def _perf_row(loan, date, f2="", fc=""):
    vals = [loan, date, f2] + [""] * 12 + [fc]
    return tuple(vals)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_entry_one_row_per_loan_and_partition_invariant(spark, sf_small):
    perf = performance_records(spark, sf_small)
    a = labels.latest_entry(perf)
    assert a.count() == 1473
    assert a.select("loan_id").distinct().count() == 1473
    b = labels.latest_entry(perf.repartition(7, "field_03"))
    c = labels.latest_entry_struct(perf.repartition(3))
    assert _rows(a) == _rows(b) == _rows(c)


def test_latest_entry_ties_and_bad_dates(spark):
    perf = spark.createDataFrame(
        [
            _perf_row("1", "01/01/2001", "a"),
            _perf_row("1", "03/01/2001", "a"),
            _perf_row("1", "03/01/2001", "b"),  # same date: larger remaining field wins
            _perf_row("2", "not a date", "z"),
            _perf_row("2", "02/01/2000", "a"),  # parsable date beats an unparsable one
        ],
        PERF_SCHEMA,
    )
    for op in (labels.latest_entry, labels.latest_entry_struct):
        got = {r["loan_id"]: (r["reporting_date"], r["field_02"]) for r in op(perf).collect()}
        assert got == {"1": ("03/01/2001", "b"), "2": ("02/01/2000", "a")}


def test_label_join_keeps_row_count(spark, sf_small):
    loans = prepare_loans(acquisition_records(spark, sf_small))
    perf = performance_records(spark, sf_small)
    ids = labels.foreclosure_ids(perf)
    dup = ids.unionAll(ids)  # duplicated foreclosure ids must not fan out loans
    lab = labels.label_join(loans, dup)
    assert lab.count() == loans.count() == 327
    assert lab.where("is_foreclosed = 1").count() == 44
    members = labels.default_members(loans, dup).count()
    others = labels.non_default_members(loans, dup).count()
    assert members == 44 and members + others == 327


def test_non_integer_loan_id_is_not_foreclosed(spark):
    from conftest import acq_frame, acq_row

    loans = prepare_loans(acq_frame(spark, [acq_row(loan_id="abc"), acq_row(loan_id="7")]))
    ids = spark.createDataFrame([(7,), (7,), (None,)], "f_loan_id bigint")
    got = {r["loan_id"]: r["is_foreclosed"] for r in labels.label_join(loans, ids).collect()}
    assert got == {"abc": 0, "7": 1}


def test_counts(spark, sf_small):
    lab = labels.labelled_loans(prepare_loans(acquisition_records(spark, sf_small)), performance_records(spark, sf_small))
    r = labels.default_count(lab).first()
    assert (r["n_loans"], r["n_foreclosed"]) == (327, 44)
    by_class = {r["is_foreclosed"]: r["n"] for r in labels.default_by_class(lab).collect()}
    assert by_class == {0: 283, 1: 44}
    by_year = labels.default_by_group(lab).collect()
    assert sum(r["n_loans"] for r in by_year) == 327


def test_latest_entry_plan_reduces_before_shuffle(spark, sf_small):
    perf = performance_records(spark, sf_small)
    plan = labels.latest_entry_struct(perf)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    wplan = labels.latest_entry(perf)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in wplan and "Partial" in wplan


def test_sql_over_registered_views(spark, sf_small):
    from loanlens.sources import register_view

    lab = labels.labelled_loans(prepare_loans(acquisition_records(spark, sf_small)), performance_records(spark, sf_small))
    register_view(lab, "loan_labels")
    n = spark.sql("SELECT count(*) AS n FROM loan_labels WHERE f_loan_id IS NOT NULL").first()["n"]
    by_class = {r[0]: r[1] for r in spark.sql("SELECT is_foreclosed, count(*) FROM loan_labels GROUP BY is_foreclosed").collect()}
    assert n == 44 and by_class == {r["is_foreclosed"]: r["n"] for r in labels.default_by_class(lab).collect()}


def test_incremental_latest_equals_full(spark, sf_small):
    perf = performance_records(spark, sf_small)
    early = perf.where("substr(reporting_date, 7, 4) < '1998'")
    late = perf.where("substr(reporting_date, 7, 4) >= '1998'")
    assert early.count() > 0 and late.count() > 0
    prior = labels.latest_entry(early)
    updated = labels.update_latest_entry(prior, late)
    assert _rows(updated) == _rows(labels.latest_entry(perf))


def test_label_join_shuffles_each_side_once(spark):
    from conftest import acq_frame, acq_row

    loans = prepare_loans(acq_frame(spark, [acq_row(loan_id=str(i)) for i in range(20)]))
    ids = spark.createDataFrame([(i,) for i in range(0, 20, 3)] * 2, "f_loan_id bigint")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = labels.label_join(loans, ids)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange hashpartitioning") == 2  # loans by key, ids once (distinct + join)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_label_views_for_existing_sql(spark, sf_small):
    lab = labels.labelled_loans(prepare_loans(acquisition_records(spark, sf_small)), performance_records(spark, sf_small))
    labels.register_label_views(lab)
    n = spark.sql("SELECT count(*) AS n FROM loan_data_default WHERE default IS NOT NULL").first()["n"]
    per_class = dict(spark.sql("SELECT is_foreclosed, count(*) FROM loan_data_default_joined GROUP BY is_foreclosed").collect())
    assert n == labels.default_count(lab).first()["n_foreclosed"] == 44
    assert per_class == {0: 283, 1: 44}
