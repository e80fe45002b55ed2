"""Summarize a Spark event log: slowest stages and task counts.

usage: python tools/stage_times.py <event_log_dir_or_file> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _files(path: str):
    if os.path.isfile(path):
        yield path
        return
    for root, _, names in os.walk(path):
        for n in sorted(names):
            if n.startswith("events") or n.startswith("local-") or n.startswith("app-"):
                yield os.path.join(root, n)


def _lines(path: str):
    """Event-log lines; zstd-compressed logs (Spark's default codec) are decompressed."""
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
            yield from text
        return
    with open(path, encoding="utf-8") as fh:
        yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    tasks: dict[int, list[int]] = {}
    for f in _files(path):
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                                   info["Stage Name"][:70]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    print("   stage time   id  tasks  task median / max (s)  name")
    for ms, sid, n, name in sorted(stages, reverse=True)[:top]:
        t = sorted(tasks.get(sid, [0]))
        print(f"{ms / 1000:9.2f} s {sid:5d} {n:6d}   {t[len(t) // 2] / 1000:6.2f} / {t[-1] / 1000:6.2f}      {name}")


if __name__ == "__main__":
    main()
