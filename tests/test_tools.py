"""The event-log summary script used for stage/task timing."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stage_times_summary(tmp_path):
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage Infos": [{"Stage ID": 0}, {"Stage ID": 1}],
         "Properties": {"spark.job.description": "q2"}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0},
        {"Event": "SparkListenerStageCompleted",
         "Stage Info": {"Stage ID": 0, "Stage Name": "scan", "Submission Time": 100, "Completion Time": 350}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1},
        {"Event": "SparkListenerStageCompleted",
         "Stage Info": {"Stage ID": 1, "Stage Name": "agg", "Submission Time": 360, "Completion Time": 410}},
    ]
    log = tmp_path / "events.json"
    log.write_text("\n".join(json.dumps(e) for e in events) + "\n")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "scripts", "stage_times.py"), str(log)],
                         capture_output=True, text=True, check=True, timeout=60).stdout.splitlines()
    assert out[0].split()[:3] == ["job", "0", "300"] and out[0].endswith("q2")
    assert out[1].split()[:6] == ["stage", "0", "250", "ms", "2", "tasks"]
    assert out[2].split()[:6] == ["stage", "1", "50", "ms", "1", "tasks"]
