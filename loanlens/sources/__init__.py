"""Readers and writers: pipe text (plain / bzip2), legacy tuple text, Parquet, driver tables."""

from loanlens.sources.landing import check_landing, land_acquisition, land_performance, manifest, read_landed  # noqa: F401
from loanlens.sources.results import publish, read_table  # noqa: F401
from loanlens.sources.tables import acquisition_records, performance_records, table  # noqa: F401
from loanlens.sources.text import (  # noqa: F401
    format_legacy_foreclosures,
    parse_legacy_foreclosures,
    parse_pipe_lines,
    read_acquisition,
    read_legacy_foreclosures,
    read_performance,
    read_pipe_text,
    read_reconciled,
    to_pipe_lines,
    write_pipe_text,
)
from loanlens.sources.sinks import register_view, to_pandas_bounded, write_metrics, write_parquet  # noqa: F401
