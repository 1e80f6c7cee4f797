"""Sinks: Parquet tables, the metrics table, temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame

METRICS_SCHEMA = "year int, model string, metric string, value double"


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """Append ``(year, model, metric, value)`` rows, partitioned by year.

    One table replaces the per-model text directories; a rerun of one year
    overwrites only that year's partition when ``mode='overwrite'`` and
    dynamic partition overwrite is enabled.
    """
    (
        metrics.selectExpr("cast(year as int) year", "model", "metric", "cast(value as double) value")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def to_pandas_bounded(df: DataFrame, max_rows: int = 100_000):
    """``toPandas`` for results that are known to be small; refuses anything larger.

    Fetches at most ``max_rows + 1`` rows, so an unexpectedly large result
    fails fast instead of filling the driver.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to storage instead")
    return pdf
