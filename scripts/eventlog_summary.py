"""Per-query stage summary from a Spark event log (written by bench.py with BENCH_EVENTLOG).

usage: python scripts/eventlog_summary.py EVENTLOG_FILE
Prints, per job description (query key), the number of stages and tasks, the summed executor
run time and the slowest stage.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of a single event-log file, or of a rolling event-log folder (events_<n>_... files)."""
    if os.path.isdir(path):
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(re.match(r"events_(\d+)", f).group(1)))
        paths = [os.path.join(path, f) for f in files]
    else:
        paths = [path]
    for p in paths:
        if p.endswith(".zstd"):
            import io

            import zstandard
            with open(p, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(p) as f:
                yield from f


def main(path: str) -> None:
    stage_job = {}
    per = defaultdict(lambda: {"stages": 0, "tasks": 0, "run_ms": 0, "max_stage_ms": 0, "max_stage": ""})
    for line in _lines(path):
        if True:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "?")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = desc
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                desc = stage_job.get(info["Stage ID"], "?")
                run = sum(a.get("Value", 0) for a in info.get("Accumulables", [])
                          if a.get("Name") == "internal.metrics.executorRunTime")
                dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                p = per[desc]
                p["stages"] += 1
                p["tasks"] += info.get("Number of Tasks", 0)
                p["run_ms"] += int(run)
                if dur > p["max_stage_ms"]:
                    p["max_stage_ms"], p["max_stage"] = dur, info.get("Stage Name", "")[:60]
    for desc, p in sorted(per.items()):
        print(f"{desc:28s} stages={p['stages']:4d} tasks={p['tasks']:5d} run_ms={p['run_ms']:7d} "
              f"slowest={p['max_stage_ms']}ms {p['max_stage']}")


if __name__ == "__main__":
    main(sys.argv[1])
