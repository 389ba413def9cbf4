"""Figures of a Spark event log, by job description."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_SESSION = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
         .config("spark.eventLog.dir", {log!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
"""


def run_logged(script: str, folder: str) -> dict[str, dict[str, int]]:
    """Run ``script`` (it has ``spark`` and ``F``; ``spark.sparkContext.setJobDescription`` names its parts) in a
    process of its own. Per description: ``tasks, rows_read, bytes_read, shuffle_bytes``."""
    log = os.path.join(folder, "events")
    os.makedirs(log, exist_ok=True)
    code = _SESSION.format(root=ROOT, log="file://" + log) + script + "\nspark.stop()\n"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    part, out = {}, defaultdict(lambda: defaultdict(int))
    for name in os.listdir(log):
        with open(os.path.join(log, name)) as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerJobStart":
                    for stage in event["Stage IDs"]:
                        part[stage] = (event.get("Properties") or {}).get("spark.job.description", "")
                elif event["Event"] == "SparkListenerTaskEnd":
                    own, m = out[part[event["Stage ID"]]], event["Task Metrics"]
                    own["tasks"] += 1
                    own["rows_read"] += m["Input Metrics"]["Records Read"]
                    own["bytes_read"] += m["Input Metrics"]["Bytes Read"]
                    own["shuffle_bytes"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    return {k: dict(v) for k, v in out.items()}
