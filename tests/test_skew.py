"""A key holding a third of all rows must not change results (and is pre-aggregated)."""

from pyspark.sql import functions as F

from loanlens.operators import labels
from loanlens.operators.cleaning import prepare_loans
from loanlens.schemas import PERF_FIELDS
from loanlens.sources import acquisition_records, performance_records


def _hot_perf(spark, sf):
    perf = performance_records(spark, sf)
    hot = F.when(F.col("field_03").cast("bigint") % 3 == 0, F.lit("1")).otherwise(F.col("loan_id"))
    return perf.withColumn("loan_id", hot).select(*PERF_FIELDS)


def test_latest_entry_with_hot_loan(spark, sf_small):
    perf = _hot_perf(spark, sf_small)
    share = perf.where("loan_id = '1'").count() / perf.count()
    assert share > 0.3
    a = sorted(tuple(r) for r in labels.latest_entry(perf).collect())
    b = sorted(tuple(r) for r in labels.latest_entry_struct(perf.repartition(5)).collect())
    assert a == b
    pdf = perf.toPandas()
    hot = pdf[pdf.loan_id == "1"].copy()
    hot["d"] = hot.reporting_date.str.slice(6, 10) + hot.reporting_date.str.slice(0, 2) + hot.reporting_date.str.slice(3, 5)
    best = hot.sort_values(["d"] + [c for c in PERF_FIELDS if c != "loan_id"], ascending=False).iloc[0]
    got = [r for r in a if r[0] == "1"][0]
    assert list(got) == [best[c] for c in PERF_FIELDS]


def test_label_join_with_many_unmatched_ids(spark, sf_small):
    from loanlens.operators.labels import label_join, foreclosure_ids

    acq = acquisition_records(spark, sf_small)
    bad = F.when(F.col("loan_id").cast("bigint") % 3 == 0, F.lit("x")).otherwise(F.col("loan_id"))
    loans = prepare_loans(acq.withColumn("loan_id", bad))
    lab = label_join(loans, foreclosure_ids(performance_records(spark, sf_small)))
    assert lab.count() == loans.count()
    assert lab.where("loan_id = 'x' AND is_foreclosed = 1").count() == 0


def test_label_join_spreads_unparsable_ids(spark, sf_small):
    from loanlens.operators.labels import foreclosure_ids, label_join

    acq = acquisition_records(spark, sf_small)
    bad = F.when(F.col("loan_id").cast("bigint") % 3 == 0, F.lit("x")).otherwise(F.col("loan_id"))
    loans = prepare_loans(acq.withColumn("loan_id", bad))
    ids = foreclosure_ids(performance_records(spark, sf_small))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys[:2]:
            spark.conf.set(k, "-1")
        spark.conf.set(keys[2], "false")
        joined = label_join(loans, ids)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        alone = loans._jdf.queryExecution().executedPlan().toString()
        # one exchange for the loans and one for the ids, which are de-duplicated on the join keys
        assert plan.count("Exchange hashpartitioning") == alone.count("Exchange hashpartitioning") + 2
        part = joined.where("loan_id = 'x'").groupBy(F.spark_partition_id()).count().collect()
        n = joined.where("loan_id = 'x'").count()
        assert n > 50 and len(part) > 4 and max(r["count"] for r in part) < n / 2
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
