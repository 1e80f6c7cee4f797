"""Result tables keyed by year: a run replaces its own years in all tables at once and leaves the others.

The tables of a run are staged and committed together (:mod:`loanlens.sources.commit`), laid out as
``out/<table>/year=<year>``. So readers of ``out`` never find a year whose metrics are of one run and whose
curves of another, also when the job died while it published them: :func:`read_table` finishes a begun commit first.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.sources.commit import Folder, StagedWrite, recover

YEAR = "year"
# Fixed value: the folder name that Spark gives a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def year_folder(table: str, year: int | None) -> str:
    return f"{table}/{YEAR}={NULL_PARTITION if year is None else int(year)}"


def _of_years(df: DataFrame, years: list[int | None]) -> DataFrame:
    known = [y for y in years if y is not None]
    keep = F.col(YEAR).isin(known) if known else F.lit(False)
    return df.where(F.coalesce(keep, F.lit(False)) | (F.col(YEAR).isNull() if None in years else F.lit(False)))


def publish(
    spark: SparkSession, tables: dict[str, DataFrame], out: str, years: list[int | None], texts: dict[str, DataFrame] | None = None
) -> None:
    """Replace the rows of ``years`` in every table of ``out`` by those of ``tables`` (each with a ``year``), as one commit.

    A year that a table has no rows for loses its earlier rows there, too. Rows of other years are not written.
    ``texts`` are folders of text (frames of one text column) that are replaced as a whole in the same commit.
    """
    write = StagedWrite(spark, out)

    def stage(item: tuple[str, DataFrame]) -> None:
        name, df = item
        rows = _of_years(df.withColumn(YEAR, F.col(YEAR).cast("int")), years)
        rows.write.partitionBy(YEAR).parquet(write.folder(name))

    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        list(pool.map(stage, tables.items()))
    for name, lines in (texts or {}).items():
        lines.coalesce(1).write.text(write.folder(name))
    write.commit([year_folder(name, y) for name in tables for y in years] + list(texts or {}))


def read_table(spark: SparkSession, out: str, name: str, schema: str | None = None) -> DataFrame:
    """A published table, all its years. With ``schema`` (``year`` included) a table without rows is an empty frame."""
    recover(spark, out)
    store = Folder(spark, out)
    if schema is not None and not any(f.endswith(".parquet") for f in store.files(name)):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{store.root}/{name}")
