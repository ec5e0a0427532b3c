"""Job and stage durations from a Spark event log (no UI needed).

    python scripts/stage_times.py <eventlog dir or file>

Write the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<scratch folder>``; rolling (``eventlog_v2_*``) and
zstd-compressed logs are read.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                yield from io.TextIOWrapper(fh, encoding="utf-8")


def main() -> None:
    jobs: dict[int, list] = {}
    stages = []
    for line in _lines(sys.argv[1]):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, len(e["Stage Infos"])]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Completion Time" in si and "Submission Time" in si:
                stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                               si["Number of Tasks"], si["Stage Name"][:70]))
    for ms, sid, n, name in sorted(stages, reverse=True)[:25]:
        print(f"stage {sid:5d} {n:5d} tasks {ms:8d} ms  {name}")
    total = sum((b - a) for a, b, _ in jobs.values() if b)
    print(f"{len(jobs)} jobs, {len(stages)} stages, {total} ms job time")


if __name__ == "__main__":
    main()
