"""Summarize the physical plan of every registered query.

Usage: python tools/plans.py [sf_dir] [out_dir] [--no-broadcast]
Writes ``<query>.txt`` with ``explain("formatted")`` to out_dir (default: a
fresh folder under /tmp) and prints, per query, the count of shuffles,
join strategies and any single-partition exchange or Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanlens.plans.queries import QUERIES  # noqa: E402
from loanlens.session import build_session  # noqa: E402

WATCH = [
    "Exchange hashpartitioning",
    "Exchange rangepartitioning",
    "Exchange SinglePartition",
    "BroadcastExchange",
    "SortMergeJoin",
    "BroadcastHashJoin",
    "ShuffledHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "SortAggregate",
    "ObjectHashAggregate",
    "WindowGroupLimit",
    "Window ",
]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(text: str) -> dict[str, int]:
    return {k: len(re.findall(re.escape(k), text)) for k in WATCH if k in text}


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    no_broadcast = "--no-broadcast" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    out = args[1] if len(args) > 1 else tempfile.mkdtemp(prefix="loanlens-plans-")
    os.makedirs(out, exist_ok=True)
    # --no-broadcast shows the plan shape of a large input, where no side fits the broadcast threshold
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if no_broadcast else {}
    spark = build_session("plans", "local[8]", 8, extra=extra)
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        print(f"{name:26s} {summarize(plan_text(df))}")
    print("plans written to", out)
    spark.stop()


if __name__ == "__main__":
    main()
