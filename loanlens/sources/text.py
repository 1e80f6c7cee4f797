"""Pipe-delimited text sources and sinks.

Mortgage files are ``|``-separated text, often bzip2 compressed (Hadoop
decodes ``.bz2`` by extension and bzip2 is splittable, so a large file is
still read by many tasks). Reading goes through Spark's CSV source with an
explicit all-string schema: no inference pass. No field is lost without a
word: the record readers stop at a line with more fields than the layout,
:func:`read_reconciled` sets such lines aside and accounts for every one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.schemas import ACQ_FIELDS, PERF_FIELDS, text_schema
from loanlens.session import checkpointed

CORRUPT_COLUMN = "_corrupt_record"

# --- fixed values: the year embedded in an acquisition file name ---
FILE_YEAR_PATTERN = r"Acquisition[_=]?(\d{4})"


def read_pipe_text(
    spark: SparkSession,
    path: str | list[str],
    fields: list[str],
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read ``|``-separated records (plain or compressed) into named string columns.

    Blank fields arrive as null. With ``keep_corrupt`` the raw line of every
    record whose field count differs from ``fields`` is kept in
    ``_corrupt_record`` (short lines are null-padded, long ones truncated).
    """
    names = list(fields) + ([CORRUPT_COLUMN] if keep_corrupt else [])
    reader = (
        spark.read.schema(text_schema(names))
        .option("sep", "|")
        .option("header", "false")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
    )
    if keep_corrupt:
        # with pruned columns Spark doesn't compare the number of fields of a line
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("columnPruning", "false")
    return reader.csv(path)


def _surplus(line: str, names: list[str]):
    """True where a raw line has more fields than ``names``."""
    return F.regexp_count(F.col(line), F.lit(r"\|")) >= len(names)


def _refuse_wide(df: DataFrame, names: list[str], kind: str) -> DataFrame:
    """``df`` without its raw lines; one with more fields than ``names`` stops the job."""
    # Spark doesn't read the corrupt column alone, so the message names the loan, too
    message = F.concat_ws(" ", F.lit("loan"), F.col(names[0]), F.lit(f"has {kind} line of more than {len(names)} fields:"), F.col(CORRUPT_COLUMN))
    return df.where(F.when(_surplus(CORRUPT_COLUMN, names), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(CORRUPT_COLUMN)


def read_acquisition(spark: SparkSession, path: str | list[str], with_file_year: bool = True) -> DataFrame:
    """Acquisition files; ``file_year`` is taken from the file name (not the origination date).

    A line with more than the 26 fields stops the job: none is cut off silently. Missing trailing fields are null.
    """
    df = _refuse_wide(read_pipe_text(spark, path, ACQ_FIELDS, keep_corrupt=True), ACQ_FIELDS, "an acquisition")
    if with_file_year:
        year = F.regexp_extract(F.col("_metadata.file_path"), FILE_YEAR_PATTERN, 1)
        df = df.withColumn("file_year", F.nullif(year, F.lit("")).try_cast("int"))
    return df


def read_performance(spark: SparkSession, path: str | list[str], fields: list[str] | None = None) -> DataFrame:
    """Performance files (loan id, reporting date, ..., foreclosure date, ...).

    ``fields`` names all fields of a line (``perf_fields(n)`` for n of them; 16 by default). A line with more
    fields stops the job: none is cut off silently. Missing trailing fields are null.
    """
    names = fields or PERF_FIELDS
    return _refuse_wide(read_pipe_text(spark, path, names, keep_corrupt=True), names, "a performance")


GOOD, SHORT, WIDE = "good", "short", "wide"


@dataclass
class Reconciled:
    """A read in which every line is accounted for: ``lines = rows + rejected``."""

    rows: DataFrame  # the fields of the accepted lines
    rejected: DataFrame  # verdict, line
    counts: dict[str, int]  # lines, good, short, wide, rows, rejected


def read_reconciled(spark: SparkSession, path: str | list[str], fields: list[str], keep_short: bool = False) -> Reconciled:
    """Read ``|`` records and set those aside whose number of fields is not that of ``fields``.

    One pass reads and writes all lines, by verdict, to the checkpoint folder; a second one reads and counts them. The
    written rows are then counted by what was kept; any difference is an error. (No ``Observation``: one makes the
    session hold its manager, and no ``pyspark.ml`` logistic model with a summary can be sent to a task after it.)
    ``keep_short`` accepts lines with missing trailing fields, as null. Empty lines are no records.
    """
    raw = read_pipe_text(spark, path, fields, keep_corrupt=True)
    verdict = F.when(F.col(CORRUPT_COLUMN).isNull(), GOOD).when(_surplus(CORRUPT_COLUMN, fields), WIDE).otherwise(SHORT)
    judged = raw.withColumn("_verdict", verdict)
    written = checkpointed(judged, partition_by=("_verdict",))
    accepted = F.col("_verdict").isin([GOOD, SHORT] if keep_short else [GOOD])
    rows, rejected = written.where(accepted).select(*fields), written.where(~accepted).select(F.col("_verdict").alias("verdict"), F.col(CORRUPT_COLUMN).alias("line"))
    found = {r["_verdict"]: r["count"] for r in written.groupBy("_verdict").count().collect()}  # at most three rows
    tallies = [F.count(F.lit(1)).alias("lines"), *(F.count_if(F.col("_verdict") == v).alias(v) for v in (GOOD, SHORT, WIDE))]
    seen = judged.agg(*tallies, F.count(fields[0]).alias("_first")).first()  # Spark doesn't read the corrupt column alone
    counts = {k: seen[k] for k in ("lines", GOOD, SHORT, WIDE)}
    if {v: found.get(v, 0) for v in (GOOD, SHORT, WIDE)} != {v: counts[v] for v in (GOOD, SHORT, WIDE)} or sum(found.values()) != counts["lines"]:
        raise RuntimeError(f"lines read {counts} and written {found} differ")
    counts["rows"] = counts[GOOD] + (counts[SHORT] if keep_short else 0)
    counts["rejected"] = counts["lines"] - counts["rows"]
    return Reconciled(rows, rejected, counts)


def parse_pipe_lines(lines: DataFrame, fields: list[str], value_col: str = "value") -> DataFrame:
    """Split a column of raw ``|`` lines into named fields, in place of a file read.

    Same result as :func:`read_pipe_text` for well-formed lines: a blank
    field becomes null, missing trailing fields are null, surplus ones dropped.
    """
    parts = F.split(F.col(value_col), r"\|", -1)
    return lines.select(
        *[F.nullif(F.get(parts, i), F.lit("")).alias(name) for i, name in enumerate(fields)]
    )


def to_pipe_lines(df: DataFrame, fields: list[str], trailing_field: bool = False) -> DataFrame:
    """One ``value`` text column per record, nulls written as blanks."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    if trailing_field:
        cols.append(F.lit(""))
    return df.select(F.concat_ws("|", *cols).alias("value"))


def write_pipe_text(
    df: DataFrame,
    path: str,
    compression: str | None = "bzip2",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write records as ``|``-separated text (bzip2 by default, like the source files)."""
    writer = df.write.mode(mode).option("sep", "|").option("quote", "").option("emptyValue", "")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


# ---------------------------------------------------------------------------
# Legacy foreclosure list: one Python tuple repr per line, e.g. ``('123', '02/01/2001')``.
# ---------------------------------------------------------------------------

# --- fixed values: pattern of a tuple line and its two quoted members ---
LEGACY_TUPLE_PATTERN = r"^\s*\(\s*'?([^',]*?)'?\s*,\s*'([^']*)'\s*\)\s*$"


def format_legacy_foreclosures(extract: DataFrame, id_col: str = "loan_id", date_col: str = "foreclosure_date") -> DataFrame:
    """Render ``(loan id, foreclosure date)`` rows as tuple-text lines (``value``)."""
    line = F.concat(
        F.lit("('"), F.col(id_col), F.lit("', '"), F.coalesce(F.col(date_col), F.lit("")), F.lit("')")
    )
    return extract.select(line.alias("value"))


def parse_legacy_foreclosures(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse tuple-text lines without evaluating them: ``f_loan_id`` bigint and the date text.

    A line that is not a two-member tuple, or whose id is not an integer,
    yields a null id instead of failing the job.
    """
    v = F.col(value_col)
    matched = v.rlike(LEGACY_TUPLE_PATTERN)
    loan = F.when(matched, F.regexp_extract(v, LEGACY_TUPLE_PATTERN, 1))
    date = F.when(matched, F.regexp_extract(v, LEGACY_TUPLE_PATTERN, 2))
    return lines.select(
        F.trim(loan).try_cast("bigint").alias("f_loan_id"),
        F.nullif(date, F.lit("")).alias("foreclosure_date"),
    )


def read_legacy_foreclosures(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_legacy_foreclosures(spark.read.text(path))
