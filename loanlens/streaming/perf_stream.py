"""Performance files as they arrive: the same two operators, run incrementally.

Servicers publish performance files month by month. Instead of re-reading
all history, Structured Streaming can run the batch operators on each new
file set:

* :func:`foreclosure_stream` -- the foreclosure extract; stateless, append.
* :func:`latest_entry_stream` -- the latest record per loan; a streaming
  aggregate whose state (one struct per loan) lives in the state store,
  partitioned by loan id across ``spark.sql.shuffle.partitions``. It is the
  same ``max(struct)`` as the batch operator, so results agree with a batch
  run over the same files.

Both take the raw record stream from :func:`read_performance_stream`.
Checkpoint locations must be on shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loanlens.operators.cleaning import foreclosure_extract
from loanlens.operators.labels import latest_entry_struct
from loanlens.schemas import PERF_FIELDS, text_schema


def read_performance_stream(
    spark: SparkSession, path: str, fields: list[str] | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream new ``|``-separated performance files from a folder."""
    reader = (
        spark.readStream.schema(text_schema(fields or PERF_FIELDS))
        .option("sep", "|")
        .option("header", "false")
        .option("quote", "")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path)


def foreclosure_stream(perf_stream: DataFrame) -> DataFrame:
    return foreclosure_extract(perf_stream)


def latest_entry_stream(perf_stream: DataFrame) -> DataFrame:
    return latest_entry_struct(perf_stream)


def start(
    df: DataFrame,
    checkpoint: str,
    output_mode: str,
    sink: str = "parquet",
    path: str | None = None,
    query_name: str | None = None,
    trigger_available_now: bool = False,
) -> StreamingQuery:
    """Start a query with a checkpoint (required for recovery after failure)."""
    w = df.writeStream.outputMode(output_mode).format(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start(path) if path else w.start()
