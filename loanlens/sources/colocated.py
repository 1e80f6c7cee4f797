"""Tables bucketed by loan, so that joins and per-loan reductions over them need no shuffle.

Loans and their performance records are written once into the same number of buckets by the two columns that the
label join deals by anyway (:func:`loanlens.operators.labels.with_loan_keys`). From then on Spark reads
bucket ``i`` of both tables in one task: the latest record of each loan, the distinct foreclosure ids and the join of
the two run on the scan's own partitioning (no ``Exchange``).

A table is plain Parquet at a path, with its layout in ``_layout.json`` beside the data; any session can open
it again. A bucket is written by one task, so choose buckets of some hundred MB. A single loan that holds a large
share of all records makes one large bucket; there the shuffled forms of the operators, which reduce before the
exchange, are the better choice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from loanlens.operators.labels import LOAN_KEYS, with_loan_keys
from loanlens.sources.commit import Folder

LAYOUT = "_layout.json"


def _declare(spark: SparkSession, path: str, schema: str, buckets: int) -> DataFrame:
    """The bucketed files at ``path`` as a table of this session's catalog."""
    name, keys = f"colocated_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in LOAN_KEYS)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def write_colocated(df: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write loans or performance records (with a ``loan_id``) bucketed by loan; returns the table.

    Tables meant for each other take the same number of ``buckets`` (by default ``spark.sql.shuffle.partitions``).
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = with_loan_keys(df)
    name = f"colocated_{uuid.uuid4().hex}"
    # dealt by the hash that buckets go by: one file a bucket
    dealt = keyed.repartition(buckets, *LOAN_KEYS)
    dealt.write.option("path", path).bucketBy(buckets, *LOAN_KEYS).sortBy(*LOAN_KEYS).format("parquet").saveAsTable(name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(name).schema)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
    Folder(spark, path).write_text(LAYOUT, json.dumps({"buckets": buckets, "schema": schema}))
    return _declare(spark, path, schema, buckets)


def read_colocated(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`write_colocated` wrote, in this or another session."""
    layout = json.loads(Folder(spark, path).read_text(LAYOUT))
    return _declare(spark, path, layout["schema"], layout["buckets"])
