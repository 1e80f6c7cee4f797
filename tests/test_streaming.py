import os

from loanlens.operators import labels
from loanlens.operators.cleaning import foreclosure_extract
from loanlens.schemas import PERF_FIELDS
from loanlens.sources import performance_records, read_performance, to_pipe_lines
from loanlens.streaming import foreclosure_stream, latest_entry_stream, read_performance_stream, start


def test_stream_matches_batch(spark, sf_small, tmp_path):
    perf = performance_records(spark, sf_small)
    src = tmp_path / "perf"
    # two monthly drops
    to_pipe_lines(perf.where("cast(loan_id as bigint) % 2 = 0"), PERF_FIELDS).write.text(str(src / "m1"))
    to_pipe_lines(perf.where("cast(loan_id as bigint) % 2 = 1"), PERF_FIELDS).write.text(str(src / "m2"))
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(src) for f in fs if f.startswith("part-")]
    landing = tmp_path / "landing"
    landing.mkdir()
    for f in files:
        os.link(f, landing / (os.path.basename(os.path.dirname(f)) + "-" + os.path.basename(f) + ".txt"))

    stream = read_performance_stream(spark, str(landing), max_files_per_trigger=1)
    q1 = start(latest_entry_stream(stream), str(tmp_path / "ck1"), "complete", sink="memory", query_name="latest_mem")
    q2 = start(foreclosure_stream(stream), str(tmp_path / "ck2"), "append", sink="memory", query_name="fc_mem")
    q1.processAllAvailable()
    q2.processAllAvailable()
    got_latest = sorted(tuple(r) for r in spark.table("latest_mem").collect())
    got_fc = sorted(tuple(r) for r in spark.table("fc_mem").collect())
    q1.stop()
    q2.stop()

    batch = read_performance(spark, str(landing))
    assert got_latest == sorted(tuple(r) for r in labels.latest_entry(batch).collect())
    assert got_fc == sorted(tuple(r) for r in foreclosure_extract(batch).collect())
    assert len(got_latest) == 1473


def test_stream_restarts_from_checkpoint(spark, sf_small, tmp_path):
    perf = performance_records(spark, sf_small)
    landing = tmp_path / "landing"
    landing.mkdir()
    staging = tmp_path / "staging"

    def drop(name, cond):
        to_pipe_lines(perf.where(cond), PERF_FIELDS).coalesce(1).write.text(str(staging / name))
        part = [f for f in os.listdir(staging / name) if f.startswith("part-")][0]
        os.link(staging / name / part, landing / f"{name}.txt")

    out, ck = str(tmp_path / "fc_out"), str(tmp_path / "fc_ck")
    drop("m1", "cast(loan_id as bigint) % 2 = 0")
    q = start(foreclosure_stream(read_performance_stream(spark, str(landing))), ck, "append", path=out, trigger_available_now=True)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    drop("m2", "cast(loan_id as bigint) % 2 = 1")
    # a new query on the same checkpoint picks up only the new file
    q = start(foreclosure_stream(read_performance_stream(spark, str(landing))), ck, "append", path=out, trigger_available_now=True)
    q.awaitTermination()
    total = spark.read.parquet(out)
    assert 0 < first < total.count() == 220
    assert sorted(tuple(r) for r in total.collect()) == sorted(tuple(r) for r in foreclosure_extract(perf).collect())


def test_latest_entry_stream_update_mode(spark, sf_small, tmp_path):
    perf = performance_records(spark, sf_small)
    landing = tmp_path / "landing"
    to_pipe_lines(perf, PERF_FIELDS).write.text(str(landing))
    stream = read_performance_stream(spark, str(landing))
    q = start(latest_entry_stream(stream), str(tmp_path / "ck"), "update", sink="memory", query_name="latest_upd")
    q.processAllAvailable()
    rows = spark.table("latest_upd")
    q.stop()
    # one micro-batch over all files: the updated rows are exactly the batch result
    assert sorted(tuple(r) for r in rows.collect()) == sorted(tuple(r) for r in labels.latest_entry(read_performance(spark, str(landing))).collect())
