"""Per-stage timings of registered queries from Spark's event log (no web UI).

Usage: python tools/stage_times.py <sf_dir> <query> [<query> ...]
The event log goes to a fresh scratch folder; each query runs once as a
warm-up and once measured (``noop`` sink), and the measured jobs' stages
are printed with their duration and task count.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanlens.plans.queries import QUERIES  # noqa: E402
from loanlens.session import build_session  # noqa: E402


def _events(folder: str):
    for f in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        name = os.path.basename(f)
        if not name.startswith("events") and not name.startswith("local-"):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    scratch = tempfile.mkdtemp(prefix="run-stages-")
    spark = build_session(
        "stage-times",
        "local[8]",
        16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        },
    )
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    for name in names:
        sink(QUERIES[name](spark, sf_dir))
        spark.sparkContext.setJobGroup(name, name)
        sink(QUERIES[name](spark, sf_dir))
        spark.sparkContext.setJobGroup("", "")
    spark.stop()
    jobs, stages = {}, {}
    for e in _events(scratch):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            jobs[e["Job ID"]] = [group, e["Submission Time"], [s["Stage ID"] for s in e["Stage Infos"]]]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"] - jobs[e["Job ID"]][1]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], si["Stage Name"][:48])
    for name in names:
        print(f"== {name}")
        for jid, (group, ms, sids) in sorted(jobs.items()):
            if group != name:
                continue
            print(f"  job {jid}: {ms} ms")
            for sid in sids:
                if sid in stages:
                    dur, tasks, label = stages[sid]
                    print(f"    stage {sid}: {dur} ms, {tasks} tasks  {label}")


if __name__ == "__main__":
    main()
