"""Land raw text files as partitioned Parquet once, so later jobs read columns, not text.

Decompressing and parsing bzip2 text is the most expensive part of every
job over the raw files. Written once as Parquet, a job reads only the
columns it references (e.g. two of the performance fields for the
foreclosure extract) and prunes whole partitions by year.

* acquisition files -> partitioned by ``source_file``, ``file_year`` (from the file name)
* performance files -> partitioned by ``source_file``, ``reporting_year`` (from the record date)

What is landed is what the manifest says, a small table ``_manifest`` beside the data: one row a file with its
path, size and time of change, and the number and checksum of the rows landed from it. Data
and manifest are staged and committed together (:mod:`loanlens.sources.commit`), so a folder without a
manifest row is what a failed job left, and its file is landed again. A file whose size or time of
change differs from its manifest row was delivered anew; its rows replace the earlier ones. All others are left out,
unless ``replace=True``. Only files to be landed are read. A file of no bytes is not listed.

The unit of replacement is the source file, never the year. Before the write, rows are dealt
by (file, year) with Spark's rebalance hint: AQE splits a large year into
files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and joins
small ones, so neither one task gets a year nor every task writes a file for
every year. Performance rows are sorted by loan id inside their file.

Fields stay text, exactly as in the files (blank -> null), so every operator
runs unchanged on the landed tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.schemas import PERF_DATE, PERF_LOAN_ID
from loanlens.sources.commit import Folder, StagedWrite, recover
from loanlens.sources.text import read_acquisition, read_performance

SOURCE_FILE = "source_file"
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "source_file string, path string, size bigint, changed timestamp, rows bigint, checksum string, run string"


def reporting_year(col: str = PERF_DATE):
    """Year of a ``MM/dd/yyyy`` text date (null when malformed)."""
    return F.get(F.split(F.trim(F.col(col)), "/"), 2).try_cast("int")


def source_key():
    """Name of the file a row came from, with a short hash of its path: equal names in other folders stay apart."""
    return F.concat_ws("-", F.col("_metadata.file_name"), F.substring(F.sha2(F.col("_metadata.file_path"), 256), 1, 12))


def source_files(spark: SparkSession, src: str | list[str]) -> DataFrame:
    """``source_file, path, size, changed`` of the files that a read of ``src`` takes; their content is not read."""
    return spark.read.format("binaryFile").load(src).select(
        source_key().alias(SOURCE_FILE), "path", F.col("length").alias("size"), F.col("modificationTime").alias("changed")
    )


def manifest(spark: SparkSession, dst: str) -> DataFrame:
    """The last committed manifest row of each source file of a landed table."""
    recover(spark, dst)
    if not Folder(spark, dst).files(MANIFEST):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{dst.rstrip('/')}/{MANIFEST}")
    return rows.groupBy(SOURCE_FILE).agg(F.max_by(F.struct(*rows.columns[1:]), "run").alias("_last")).select(SOURCE_FILE, "_last.*")


def _names(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def _leftovers(spark: SparkSession, dst: str, known: DataFrame) -> list[str]:
    """Source files whose folder is there without a manifest row."""
    folders = [n.split("=", 1)[1] for n, is_folder, _ in Folder(spark, dst).children() if is_folder and n.startswith(f"{SOURCE_FILE}=")]
    landed = {r[0] for r in known.select(SOURCE_FILE).collect()}  # one row a file
    return sorted({_names(spark).unescapePathName(n) for n in folders} - landed)


def read_landed(spark: SparkSession, dst: str) -> DataFrame:
    """The rows of a landed table that its manifest answers for (no columns but the file's where nothing is landed)."""
    known = manifest(spark, dst)
    folders = any(n.startswith(f"{SOURCE_FILE}=") for n, _, _ in Folder(spark, dst).children())
    if not folders:
        return known.select(SOURCE_FILE).limit(0)
    left = _leftovers(spark, dst, known)
    table = spark.read.parquet(dst)
    return table.where(~F.col(SOURCE_FILE).isin(left)) if left else table


def _row_checksum(columns: list[str]):
    """Of a set of rows, whatever their order; repeated rows count."""
    return F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)")).cast("string")


def _landed_counts(rows: DataFrame) -> DataFrame:
    fields = sorted(c for c in rows.columns if c != SOURCE_FILE)
    return rows.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"), _row_checksum(fields).alias("checksum"))


def check_landing(spark: SparkSession, dst: str) -> DataFrame:
    """``source_file, rows, found_rows, ok``: the landed rows counted and summed up anew, against the manifest."""
    found = _landed_counts(read_landed(spark, dst)).select(SOURCE_FILE, F.col("rows").alias("found_rows"), F.col("checksum").alias("found"))
    both = manifest(spark, dst).join(found, SOURCE_FILE, "full")
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    same = (number("rows") == number("found_rows")) & F.coalesce("checksum", F.lit("")).eqNullSafe(F.coalesce("found", F.lit("")))
    return both.select(SOURCE_FILE, number("rows").alias("rows"), number("found_rows").alias("found_rows"), same.alias("ok"))


def _land(
    spark: SparkSession, src: str | list[str], dst: str, read: Callable[[list[str]], DataFrame], year: str, sort: list[str], replace: bool
) -> DataFrame:
    write = StagedWrite(spark, dst)
    offered = source_files(spark, src)
    todo = offered if replace else offered.join(manifest(spark, dst), [SOURCE_FILE, "size", "changed"], "left_anti")
    files = todo.select(SOURCE_FILE, "path", "size", "changed").collect()  # one row a file; Spark's reader lists them on the driver, too
    if not files:
        return read_landed(spark, dst)
    rows = read([re.sub(r"([\[\]{}?*\\])", r"\\\1", f["path"]) for f in files]).withColumn(SOURCE_FILE, source_key())
    dealt = rows.hint("rebalance", SOURCE_FILE, year).sortWithinPartitions(SOURCE_FILE, year, *sort)
    dealt.write.partitionBy(SOURCE_FILE, year).parquet(write.folder())
    listed = spark.createDataFrame([tuple(f) for f in files], "source_file string, path string, size bigint, changed timestamp")
    counts = _landed_counts(spark.read.schema(rows.schema).parquet(write.folder()))
    entries = listed.join(counts, SOURCE_FILE, "left").select(
        SOURCE_FILE, "path", "size", "changed", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "checksum", F.lit(write.run).alias("run")
    )
    entries.coalesce(1).write.parquet(write.folder(MANIFEST))
    write.commit([f"{SOURCE_FILE}={_names(spark).escapePathName(f[SOURCE_FILE])}" for f in files])
    return read_landed(spark, dst)


def land_acquisition(spark: SparkSession, src: str | list[str], dst: str, replace: bool = False) -> DataFrame:
    """Acquisition records of ``src`` added to the table ``dst``; returns the whole table."""
    return _land(spark, src, dst, lambda paths: read_acquisition(spark, paths, with_file_year=True), "file_year", ["loan_id"], replace)


def land_performance(
    spark: SparkSession, src: str | list[str], dst: str, fields: list[str] | None = None, replace: bool = False
) -> DataFrame:
    """Performance records of ``src`` with all their ``fields`` added to the table ``dst``; returns the whole table."""

    def read(paths: list[str]) -> DataFrame:
        return read_performance(spark, paths, fields).withColumn("reporting_year", reporting_year())

    return _land(spark, src, dst, read, "reporting_year", [PERF_LOAN_ID], replace)
