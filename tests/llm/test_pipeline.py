"""The corpus pipeline stage by stage, the registered queries and their oracle."""

import hashlib
import os
import subprocess
import sys

import duckdb
import pytest
from helpers import DOC
from test_pair_operators import brute_join, brute_matches
from test_span_operators import brute_secrets

import __spark_entry__ as entry
import corpus_pipeline
from loanlens.llm import mil_quality, registry
from loanlens.llm.common import materialize, table

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*registry.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and "op5_decontaminate" in entry.oracle_sql()


def test_every_oracle_is_sql():
    assert {k for k, v in entry.oracle_sql().items() if not isinstance(v, str)} == set()


def test_entry_serves_the_rest_without_the_subpackage():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1:] == ["False", "True"]


def test_decontamination_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    expected = con.execute(registry.ORACLE_SQL["op5_decontaminate"])
    names = [d[0] for d in expected.description]
    out = registry.QUERIES["op5_decontaminate"](spark, sf_small).select(*names)
    assert sorted(map(tuple, out.collect())) == sorted(expected.fetchall())


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """Each stage with its input and its result."""
    docs, out = table(spark, sf_small, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_small))
        out[name] = (before, docs)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "secret_scan", "encode"]
    for name, (before, after) in stages.items():
        if name != "encode":
            assert after.dtypes == before.dtypes, name


def test_quality_stage_drops_what_the_classifier_rejects(spark, sf_small, stages):
    before, after = stages["quality"]
    scores = mil_quality.score(before, mil_quality.fit_outside_fold(spark, before, sf_small))
    assert ids(after) == ids(scores.where(f"score >= {mil_quality.THRESHOLD}"))
    assert 0 < after.count() < before.count()


def test_near_duplicate_stage_keeps_the_least_of_each_component(stages):
    before, after = stages["near_duplicates"]
    component, _ = brute_join([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == {i for i, c in component.items() if i == c}


def test_decontamination_stage(spark, sf_small, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    suspects = [(i, t) for i, t in rows if i in ids(before) - ids(after)]
    assert {i for i, _ in brute_matches(suspects, items)} == {i for i, _ in suspects}
    some = [(i, t[:4000]) for i, t in rows if i in ids(after)][:25]
    assert not brute_matches(some, items)


def test_secret_stage_masks_every_base_secret_and_keeps_all_rows(stages):
    before, after = stages["secret_scan"]
    old, new = ({r.doc_id: r for r in df.collect()} for df in (before, after))
    assert set(old) == set(new)
    assert not any(brute_secrets(r.text or "") for r in new.values())
    for i, r in new.items():
        assert r.text == old[i].text or "[SECRET]" in r.text
        assert r.n_chars == len(r.text)


def test_encode_stage(stages):
    before, after = stages["encode"]
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    out = after.collect()
    assert {r.doc_id for r in out} == set(texts)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in out)


def test_pipeline_query_is_the_chain(spark, sf_small, stages):
    got = sorted(map(tuple, entry.queries()["pipeline"](spark, sf_small).collect()))
    assert got == sorted(map(tuple, stages["encode"][1].collect()))


def test_pipeline_on_empty_documents(spark, sf_small):
    docs = spark.createDataFrame([], DOC)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_small))
        assert docs.count() == 0, name
