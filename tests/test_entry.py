import os
import sys

import duckdb
from pyspark.sql.pandas.types import to_arrow_schema

import __spark_entry__ as E
from loanlens.plans.queries import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, canon  # noqa: E402

ROWS_ONLY = {
    "logistic_auc",
    "forest_auc",
    "gbt_auc",
    "logistic_confusion",
    "gbt_confusion",
    "logistic_curve",
    "gbt_curve",
    "yearly_report",
}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["origination_year", "n_loans", "n_foreclosed", "foreclosure_rate"]
    assert sum(r["n_loans"] for r in rows) == 327


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(sql) == ROWS_ONLY


def test_sql_queries_match_duckdb(spark, sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    q, sql = E.queries(), E.oracle_sql()
    bad = []
    for name, stmt in sql.items():
        if name not in QUERIES:
            continue  # those of a subpackage are tested with it
        df = q[name](spark, sf_small)
        s_rows, s_cols = [tuple(r) for r in df.collect()], df.columns
        assert len(set(s_cols)) == len(s_cols), name
        res = con.execute(stmt)
        d_cols = [d[0] for d in res.description]
        d_rows = res.fetchall()
        # column types agree too (as Arrow types, which is how both engines export results)
        s_types = {f.name: str(f.type) for f in to_arrow_schema(df.schema)}
        d_types = {f.name: str(f.type) for f in con.execute(stmt).to_arrow_table().schema}
        if s_types != d_types:
            bad.append(name + " (types)")
        if sorted(s_cols) != sorted(d_cols) or canon(s_rows, s_cols) != canon(d_rows, d_cols):
            bad.append(name)
    assert bad == []


def test_rows_only_queries_run(spark, sf_small):
    q = E.queries()
    for name in sorted(ROWS_ONLY):
        df = q[name](spark, sf_small)
        assert len(set(df.columns)) == len(df.columns), name
        assert df.count() > 0, name
