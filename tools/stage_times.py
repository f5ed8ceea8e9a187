"""Summarise a Spark event log: slowest stages with task count and the
max / median task time (a skew indicator).

usage: python tools/stage_times.py <event-log-file-or-dir> [top]
"""

from __future__ import annotations

import json
import os
import statistics
import sys


def load(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(dp, f) for dp, _, fs in os.walk(path) for f in fs)
    for fn in files:
        if fn.endswith(".zstd"):
            import io
            import zstandard
            with open(fn, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw),
                                        encoding="utf-8")
                lines = text.read().splitlines()
        else:
            with open(fn, encoding="utf-8", errors="replace") as fh:
                lines = fh.read().splitlines()
        for line in lines:
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks: dict[tuple, list[float]] = {}
    stages: dict[tuple, dict] = {}
    for ev in load(path):
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd":
            key = (ev["Stage ID"], ev["Stage Attempt ID"])
            info = ev["Task Info"]
            tasks.setdefault(key, []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
        elif kind == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            key = (si["Stage ID"], si["Stage Attempt ID"])
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages[key] = {"name": si["Stage Name"][:60], "seconds": dur,
                           "tasks": si["Number of Tasks"]}
    rows = []
    for key, st in stages.items():
        t = tasks.get(key, [0.0])
        rows.append((st["seconds"], key[0], st["tasks"], max(t), statistics.median(t), st["name"]))
    rows.sort(reverse=True)
    print(f"{'sec':>7} {'stage':>6} {'tasks':>6} {'max_task':>9} {'med_task':>9}  name")
    for sec, sid, n, mx, md, name in rows[:top]:
        print(f"{sec:7.2f} {sid:6d} {n:6d} {mx:9.2f} {md:9.2f}  {name}")
    print(f"stages: {len(rows)}, total stage seconds: {sum(r[0] for r in rows):.1f}")


if __name__ == "__main__":
    main()
