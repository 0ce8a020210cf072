"""Summarise a Spark event log (plain or zstd): slowest stages, time in tiny stages, and
stage counts by call site.  Usage: python tools/eventlog_summary.py <event log dir or file> [top]

Write one with ``BENCH_EVENT_LOG_DIR=file:/some/scratch python bench.py`` (the UI stays off)."""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    if not files and os.path.isdir(path):
        files = sorted(p for p in glob.glob(os.path.join(path, "*")) if os.path.isfile(p))
    for f in files:
        raw = open(f, "rb")
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        yield from io.TextIOWrapper(raw, encoding="utf-8")


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for line in _lines(path):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((secs, si["Stage ID"], si["Number of Tasks"], si["Stage Name"]))
    total = sum(s[0] for s in stages)
    print(f"stages {len(stages)}, stage seconds {total:.1f}")
    print(f"stages under 0.5 s: {sum(1 for s in stages if s[0] < 0.5)} ({sum(s[0] for s in stages if s[0] < 0.5):.1f} s)")
    print("slowest:")
    for secs, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"  {secs:7.2f} s  stage {sid:5d}  {tasks:5d} tasks  {name[:70]}")
    by_site = collections.Counter(s[3].split(" at ")[0] for s in stages)
    print("by call site:", by_site.most_common(8))


if __name__ == "__main__":
    main()
