"""Summarise stage and task times from a Spark event log (no UI needed).

usage: BENCH_EVENTLOG=$(mktemp -d /tmp/run-XXXXXX) BENCH_QUERIES=top_terms python bench.py
       python tools/stage_times.py <that folder> [top_n]

Per stage: wall seconds, task count, and max vs median task time; a max far
above the median means one busy task (skew, or an unsplittable input).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode("utf-8", "ignore").splitlines():
        if line.strip():
            yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    stages: dict[int, tuple] = {}
    tasks: dict[int, list[float]] = {}
    for path in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True):
        for e in _lines(path):
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (secs, si["Number of Tasks"], si["Stage Name"][:60])
            elif kind == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    print(f"{'stage':>5} {'secs':>7} {'tasks':>5} {'max':>7} {'median':>7}  name")
    for sid, (secs, n, name) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        ts = sorted(tasks.get(sid, [0.0]))
        print(f"{sid:>5} {secs:7.2f} {n:>5} {ts[-1]:7.2f} {ts[len(ts) // 2]:7.2f}  {name}")


if __name__ == "__main__":
    main()
