"""Incremental (Structured Streaming) runs of the performance-file operators."""

from loanlens.streaming.perf_stream import (  # noqa: F401
    foreclosure_stream,
    latest_entry_stream,
    read_performance_stream,
    start,
)
