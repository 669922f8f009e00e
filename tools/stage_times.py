"""Summarise stage and task times from a Spark event log (JSON lines).

usage: python tools/stage_times.py <event-log file or rolling-log directory> [top_n]
Prints the slowest stages: wall time, tasks, median / max task time (a large
max/median ratio flags skew), shuffle read / write and spill bytes.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines of a plain, zstd-compressed, or rolling (directory) event log."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(
            (os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")),
            key=lambda f: int(os.path.basename(f).split("_")[1]),
        )
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    tasks = defaultdict(list)
    shuffle = defaultdict(lambda: [0, 0, 0])
    stages = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                sid = (ev["Stage ID"], ev["Stage Attempt ID"])
                info = ev["Task Info"]
                tasks[sid].append(info["Finish Time"] - info["Launch Time"])
                m = ev.get("Task Metrics") or {}
                sr = m.get("Shuffle Read Metrics", {})
                sw = m.get("Shuffle Write Metrics", {})
                shuffle[sid][0] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                shuffle[sid][1] += sw.get("Shuffle Bytes Written", 0)
                shuffle[sid][2] += m.get("Disk Bytes Spilled", 0)
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                sid = (si["Stage ID"], si["Stage Attempt ID"])
                wall = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
                stages[sid] = (wall, si["Stage Name"][:60])
    rows = []
    for sid, (wall, name) in stages.items():
        t = tasks.get(sid, [0])
        rows.append((wall, sid[0], name, len(t), statistics.median(t), max(t), *shuffle[sid]))
    rows.sort(reverse=True)
    print(f"{'wall ms':>8} {'stage':>6} {'tasks':>6} {'med ms':>7} {'max ms':>7} {'shuf rd':>10} {'shuf wr':>10} {'spill':>8}  name")
    for wall, sid, name, n, med, mx, rd, wr, sp in rows[:top]:
        print(f"{wall:8d} {sid:6d} {n:6d} {med:7.0f} {mx:7d} {rd:10d} {wr:10d} {sp:8d}  {name}")


if __name__ == "__main__":
    main()
