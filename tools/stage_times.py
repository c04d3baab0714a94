"""Summarise stage times from a Spark event log (no UI needed).

    python tools/stage_times.py <event-log-file> [top]

Prints the slowest stages (duration, tasks, name) and the total per job group.
Write an event log with ``BENCH_EVENT_LOG=<dir> python bench.py``.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: one file, or a rolling-log folder (Spark 4),
    searched recursively."""
    if os.path.isfile(path):
        files = [path]
    else:
        files = sorted(os.path.join(d, f) for d, _s, fs in os.walk(path) for f in fs
                       if f.startswith("events_") or f.startswith("local-") or f.startswith("app-"))
    for fp in files:
        if fp.endswith(".zstd"):
            import io

            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages, job_group, stage_job = [], {}, {}
    for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                group = props.get("spark.jobGroup.id") or props.get("callSite.short", "")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    stages.append((info["Completion Time"] - info["Submission Time"],
                                   info.get("Number of Tasks"), info["Stage ID"], info.get("Stage Name", "")))
    per_group = defaultdict(int)
    for dur, _n, sid, _name in stages:
        per_group[stage_job.get(sid, "?")] += dur
    for dur, n, sid, name in sorted(stages, reverse=True)[:top]:
        print(f"{dur:7d} ms  {n:5} tasks  stage {sid:5}  [{stage_job.get(sid, '?')}] {name[:70]}")
    print("-- per job group (ms):")
    for g, ms in sorted(per_group.items(), key=lambda x: -x[1])[:top]:
        print(f"{ms:8d}  {g}")


if __name__ == "__main__":
    main()
