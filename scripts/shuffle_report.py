"""Per-query shuffle and spill totals from Spark's event log.

    python scripts/shuffle_report.py [--sf-dir DIR] [name ...]

Runs each registered query (full evaluation through the ``noop`` sink) with
the event log written to a fresh folder under /tmp, tags the query's jobs
with its name, then sums task metrics per query: jobs, stages, tasks, input
bytes, shuffle bytes written, and memory/disk spill.  The Spark UI stays off;
nothing but the log file is read.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.plans.registry import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402


def summarize(log_dir: str) -> dict[str, dict[str, int]]:
    stage_query: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    # Spark 4 writes rolling logs: one folder per application, event files inside
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and os.path.basename(p).startswith("events_"))
    for path in paths:
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    name = (ev.get("Properties") or {}).get("spark.job.description")
                    if not name:
                        continue
                    totals[name]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = name
                        totals[name]["stages"] += 1
                elif kind == "SparkListenerTaskEnd":
                    name = stage_query.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if not name or not metrics:
                        continue
                    t = totals[name]
                    t["tasks"] += 1
                    t["input_bytes"] += metrics.get("Input Metrics", {}).get("Bytes Read", 0)
                    t["shuffle_write_bytes"] += metrics.get("Shuffle Write Metrics", {}).get(
                        "Shuffle Bytes Written", 0)
                    t["memory_spill_bytes"] += metrics.get("Memory Bytes Spilled", 0)
                    t["disk_spill_bytes"] += metrics.get("Disk Bytes Spilled", 0)
    return {k: dict(v) for k, v in totals.items()}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="ledgerloom-eventlog-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                    "spark.eventLog.compress": "false"},
    )
    sc = spark.sparkContext
    for name in args.names or list(QUERIES):
        sc.setJobDescription(name)
        QUERIES[name](spark, args.sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()
    report = summarize(log_dir)
    cols = ["jobs", "stages", "tasks", "input_bytes", "shuffle_write_bytes",
            "memory_spill_bytes", "disk_spill_bytes"]
    print(f"{'query':28s} " + " ".join(f"{c:>19s}" for c in cols))
    for name in args.names or list(QUERIES):
        row = report.get(name, {})
        print(f"{name:28s} " + " ".join(f"{row.get(c, 0):>19d}" for c in cols))


if __name__ == "__main__":
    main()
