"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and forces full evaluation with the ``noop`` sink
(no collect, no driver transfer). Prints one JSON line. Arguments: query
names to run instead of the headline set, or ``--all`` for every query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanlens.plans.queries import QUERIES  # noqa: E402
from loanlens.session import build_session, release_checkpoints  # noqa: E402

HEADLINE = [
    "default_by_year",
    "latest_entry",
    "latest_entry_window",
    "label_join",
    "string_index_freq",
    "standardize",
    "correlation_long",
    "roc_curve",
    "exact_auc",
    "scatter_bins",
    "hypothesis_table",
    "logistic_auc",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    args = sys.argv[1:]
    names = list(QUERIES) if "--all" in args else ([a for a in args if not a.startswith("--")] or HEADLINE)
    scratch = tempfile.mkdtemp(prefix="loanlens-bench-")
    spark = build_session(
        "loanlens-bench",
        f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2))),
        extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"), "spark.driver.memory": "16g"},
    )
    # warm-up: JVM classes and the parquet footers
    QUERIES["default_by_year"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        release_checkpoints(spark)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
