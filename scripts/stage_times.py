"""Summarize a Spark event log: per job, its stages with task count and time.

Usage: python scripts/stage_times.py <event-log file or folder> [min_ms]
(enable logs with BENCH_EVENT_LOG_DIR=<dir> python bench.py)
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def open_log(path: str):
    """Plain or zstd event log file, or a rolling event-log folder."""
    if os.path.isdir(path):
        files = sorted(f for f in os.listdir(path) if f.startswith("events_"))
        for f in files:
            yield from open_log(os.path.join(path, f))
        return
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path) as fh:
        yield from fh


def main() -> None:
    path = sys.argv[1]
    min_ms = float(sys.argv[2]) if len(sys.argv) > 2 else 0.0
    jobs, stage_names, stage_time, stage_tasks, job_desc = {}, {}, {}, defaultdict(int), {}
    if True:
        for line in open_log(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [s["Stage ID"] for s in e["Stage Infos"]]
                job_desc[e["Job ID"]] = (e.get("Properties") or {}).get("spark.job.description", "")
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                sid = info["Stage ID"]
                stage_names[sid] = info["Stage Name"]
                if "Submission Time" in info and "Completion Time" in info:
                    stage_time[sid] = info["Completion Time"] - info["Submission Time"]
            elif kind == "SparkListenerTaskEnd":
                stage_tasks[e["Stage ID"]] += 1
    for jid, stages in sorted(jobs.items()):
        done = [s for s in stages if s in stage_time]
        total = sum(stage_time[s] for s in done)
        if total < min_ms:
            continue
        print(f"job {jid} {total:7.0f} ms {job_desc.get(jid, '')[:60]}")
        for s in done:
            print(f"   stage {s:4d} {stage_time[s]:7.0f} ms {stage_tasks[s]:5d} tasks  {stage_names[s][:70]}")


if __name__ == "__main__":
    main()
