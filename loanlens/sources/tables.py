"""Stand-in mortgage records derived from the driver's parquet tables.

The real inputs are pipe-delimited acquisition and performance files. For
tests and benchmarks they are derived here, at query time, from the
TPC-H-like tables (one acquisition row per order, one performance row per
line item). These builders only produce rows in the raw layout -- every
field is text and blank means missing -- and do none of the cleaning,
filtering, joining or aggregating that the operators perform.

The derivation is written once as Spark SQL below; the DuckDB oracle uses
the same rules (see ``loanlens.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.schemas import ACQ_FIELDS, PERF_FIELDS


# --- fixed values: schemas of the driver tables read here (no inference pass) ---
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; known tables are read with their declared schema (no inference job)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _blank_unless(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} ELSE '' END"


# Text expressions of the 26 acquisition fields over the joined order row
# (aliases: ok = order key, ck = customer key, plus n_lines/rate/ltv_num/upb).
_ACQ_EXPRS = {
    "loan_id": "cast(ok as string)",
    "channel": "o_orderstatus",
    "seller_name": "c_mktsegment",
    "original_interest_rate": (
        "concat(cast(cast(floor(rate / 100) as bigint) as string), '.', "
        "lpad(cast(rate % 100 as string), 2, '0'))"
    ),
    "original_unpaid_principal_balance": "cast(upb as string)",
    "original_loan_term": "cast(120 + 60 * n_lines as string)",
    "origination_date": "date_format(o_orderdate, 'MM/yyyy')",
    "first_payment_date": "date_format(o_orderdate + interval 2 month, 'MM/yyyy')",
    "ltv": "coalesce(cast(ltv_num as string), '')",
    "cltv": (
        "CASE WHEN ok % 37 = 0 OR ltv_num IS NULL THEN '' "
        "ELSE cast(ltv_num + CASE WHEN ok % 5 = 0 THEN 5 ELSE 0 END as string) END"
    ),
    "borrower_count": _blank_unless("ok % 101 <> 0", "cast(1 + ok % 2 as string)"),
    "dti": _blank_unless("ck % 11 <> 0", "cast(ck % 65 as string)"),
    "borrower_credit_score": _blank_unless(
        "c_acctbal >= 0", "cast(300 + cast(floor(c_acctbal) as bigint) % 551 as string)"
    ),
    "first_time_homebuyer": "CASE WHEN ok % 7 = 0 THEN 'U' WHEN ok % 7 < 3 THEN 'Y' ELSE 'N' END",
    "loan_purpose": "substr(o_orderpriority, 1, 1)",
    "property_type": "CASE ck % 3 WHEN 0 THEN 'SF' WHEN 1 THEN 'CO' ELSE 'PU' END",
    "unit_count": "cast(1 + ok % 4 as string)",
    "occupancy_status": "CASE WHEN ck % 5 = 0 THEN 'S' WHEN ck % 5 = 1 THEN 'I' ELSE 'P' END",
    "property_state": "n_name",
    "zip": "lpad(cast(ck % 1000 as string), 3, '0')",
    "insurance_percentage": (
        "CASE WHEN ltv_num >= 80 THEN cast(6 + ok % 25 as string) "
        "WHEN ok % 13 = 0 THEN '0' ELSE '' END"
    ),
    "product_type": "'FRM'",
    "co_borrower_credit_score": _blank_unless("ok % 2 = 1", "cast(300 + (ck * 13) % 551 as string)"),
    "mortgage_insurance_type": _blank_unless("ltv_num >= 80", "cast(1 + ok % 2 as string)"),
    "relocation_mortgage_indicator": "CASE WHEN ok % 50 = 0 THEN 'Y' ELSE 'N' END",
    "unknownCol": "''",
}


def acquisition_records(spark: SparkSession, sf_dir: str, with_file_year: bool = False) -> DataFrame:
    """Raw acquisition records, one per order (all ids distinct).

    Plan: line items are pre-aggregated per order (partial + final hash
    aggregate), then joined to orders on the order key; customer and nation
    are joined on their keys. Only the columns named below are scanned.
    """
    li = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.round(F.sum("l_discount") * 100).cast("bigint").alias("disc"),
            F.sum("l_quantity").cast("bigint").alias("qty"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(li, orders.o_orderkey == li.l_orderkey, "left")
        .selectExpr(
            "o_orderkey AS ok",
            "o_custkey AS ck",
            "o_orderstatus",
            "o_orderdate",
            "o_orderpriority",
            "c_acctbal",
            "c_mktsegment",
            "n_name",
            "coalesce(n_lines, 0) AS n_lines",
            "coalesce(disc, 0) + 300 AS rate",
            "20 + qty % 78 AS ltv_num",
            "cast(round(o_totalprice) as bigint) AS upb",
        )
    )
    cols = [F.expr(_ACQ_EXPRS[name]).alias(name) for name in ACQ_FIELDS]
    if with_file_year:
        cols.append(F.year("o_orderdate").alias("file_year"))
    return base.select(*cols)


# Positions 2..10 of a performance record carry line-item columns as integer
# text so that two records of one loan can be told apart; the rest are blank.
_PERF_CARRIED = {
    "field_02": "cast(l_linenumber as string)",
    "field_03": "cast(l_partkey as string)",
    "field_04": "cast(l_suppkey as string)",
    "field_05": "cast(cast(l_quantity as bigint) as string)",
    "field_06": "cast(cast(round(l_extendedprice * 100) as bigint) as string)",
    "field_07": "cast(cast(round(l_discount * 100) as bigint) as string)",
    "field_08": "cast(cast(round(l_tax * 100) as bigint) as string)",
    "field_09": "l_returnflag",
    "field_10": "l_linestatus",
}


def performance_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw performance records, one per line item (several per loan).

    The foreclosure date is set on returned, large line items; a loan can
    have several foreclosure records. A narrow projection of ``lineitem``.
    """
    date = "date_format(l_shipdate, 'MM/dd/yyyy')"
    exprs = {
        "loan_id": "cast(l_orderkey as string)",
        "reporting_date": date,
        "foreclosure_date": f"CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN {date} ELSE '' END",
        **_PERF_CARRIED,
    }
    li = table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(exprs.get(name, "''")).alias(name) for name in PERF_FIELDS])
