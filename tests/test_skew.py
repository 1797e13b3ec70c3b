"""No task of a report takes a hot key's rows from a shuffle.

A third of all jobs belongs to one piece and one technician, a third of the
history to one job, a third of the alerts to one piece, a third of the log to
one day and user; nothing is broadcast."""

import json
import subprocess
import sys
from collections import defaultdict

from conftest import ROOT
from skew_job import JOBS


def test_largest_shuffle_read(tmp_path):
    (tmp_path / "log").mkdir()
    done = subprocess.run(
        [sys.executable, str(ROOT / "tests" / "skew_job.py"), str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=900,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    stage_of, largest = {}, defaultdict(int)
    (log,) = [p for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")]
    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            name = event["Properties"].get("spark.job.description", "?")
            stage_of.update(dict.fromkeys(event["Stage IDs"], name))
        elif event["Event"] == "SparkListenerTaskEnd":
            read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            name = stage_of[event["Stage ID"]]
            largest[name] = max(largest[name], read)
    # Evenly spread, jobs and history give a task about 10,000 records; a hot
    # key would add 50,000.
    assert len(largest) == 23
    assert max(largest.values()) < JOBS // 6, dict(largest)
