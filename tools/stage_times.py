"""Summarise stage durations from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event-log-file-or-folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(fp):
    """Lines of a plain or zstd-compressed (Spark 4 default) event log."""
    if fp.endswith(".zstd"):
        import io

        import zstandard
        with open(fp, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(fp, encoding="utf-8") as fh:
            yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = []
    if os.path.isdir(path):  # rolling logs: eventlog_v2_<app>/events_<n>_<app>
        for root, _, names in os.walk(path):
            files += [os.path.join(root, n) for n in sorted(names) if n.startswith(("events", "local-", "app-"))
                      and not n.endswith((".crc",))]
    else:
        files = [path]
    stages = []
    for fp in files:
        for line in _lines(fp):
            if True:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info.get("Number of Tasks"), info.get("Stage Name", "")[:90]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f}s summed")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:8.2f}s  stage {sid:<5} tasks {tasks:<5} {name}")


if __name__ == "__main__":
    main()
