"""Summarize a Spark event log: the slowest stages, their tasks and shuffle volume.

    BENCH_EVENT_LOG=/some/scratch/dir python bench.py
    python tools/event_log_report.py /some/scratch/dir [top]

Reads plain, rolling (``eventlog_v2_*``) and zstd-compressed logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = zstandard.ZstdDecompressor().stream_reader(fh)
            else:
                stream = fh
            yield from io.TextIOWrapper(stream, encoding="utf-8")


def report(path: str, top: int = 15) -> list[str]:
    stage_query, stages, shuffle = {}, [], {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            label = props.get("spark.job.description") or props.get("callSite.short", "")
            for sid in e["Stage IDs"]:
                stage_query[sid] = " ".join(label.split())[:70]
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            sid = e["Stage ID"]
            w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            r = m.get("Shuffle Read Metrics") or {}
            rb = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
            a, b = shuffle.get(sid, (0, 0))
            shuffle[sid] = (a + w, b + rb)
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Completion Time" in si and "Submission Time" in si:
                stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                               si["Number of Tasks"], si["Stage Name"]))
    stages.sort(reverse=True)
    out = [f"stages: {len(stages)}, total stage time: {sum(s[0] for s in stages)} ms",
           "| ms | stage | tasks | shuffle write | shuffle read | job |", "|---|---|---|---|---|---|"]
    for ms, sid, tasks, name in stages[:top]:
        w, r = shuffle.get(sid, (0, 0))
        out.append(f"| {ms} | {sid} {name[:40]} | {tasks} | {w} | {r} | "
                   f"{stage_query.get(sid, '')} |")
    return out


if __name__ == "__main__":
    print("\n".join(report(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)))
