"""Stage and task times per query from a Spark event log (no UI, no REST).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python -m newsmart.profiling <that dir>

``bench.py`` tags every query's jobs with a job group named after the query.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(paths: list[str]):
    """Event lines from plain or zstd-compressed (Spark 4 default) event files."""
    for path in paths:
        if path.endswith(".zstd"):
            import io

            import zstandard

            with open(path, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(path, encoding="utf-8") as f:
                yield from f


def summarize(event_files: list[str]) -> dict[str, dict]:
    """Per job group: jobs, stages, tasks, summed stage wall time and the slowest stages."""
    group_of_stage: dict[int, str] = {}
    jobs: dict[str, int] = defaultdict(int)
    stages: dict[str, list[tuple[float, str, int]]] = defaultdict(list)
    for line in _lines(event_files):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id") or "-"
            jobs[group] += 1
            for sid in ev.get("Stage IDs", []):
                group_of_stage[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start is None or end is None:
                continue
            group = group_of_stage.get(info["Stage ID"], "-")
            stages[group].append(((end - start) / 1000.0, info["Stage Name"], info["Number of Tasks"]))
    out = {}
    for group in set(jobs) | set(stages):
        st = sorted(stages.get(group, []), reverse=True)
        out[group] = {
            "jobs": jobs.get(group, 0),
            "stages": len(st),
            "tasks": sum(s[2] for s in st),
            "stage_seconds": round(sum(s[0] for s in st), 2),
            "slowest": [(round(s[0], 2), s[1][:60], s[2]) for s in st[:3]],
        }
    return out


def latest_log(folder: str) -> list[str]:
    """Event files of the newest application under ``folder`` (rolling v2 folders
    ``eventlog_v2_<app>/events_<n>_<app>[.zstd]`` or single v1 files), in order."""
    apps = glob.glob(os.path.join(folder, "*"))
    newest = max(apps, key=os.path.getmtime)
    if os.path.isfile(newest):
        return [newest]
    parts = glob.glob(os.path.join(newest, "events_*"))
    return sorted(parts, key=lambda p: int(os.path.basename(p).split("_")[1]))


if __name__ == "__main__":
    path = sys.argv[1]
    report = summarize(latest_log(path) if os.path.isdir(path) else [path])
    for group, r in sorted(report.items(), key=lambda kv: -kv[1]["stage_seconds"]):
        print(f"{group:28s} jobs={r['jobs']:3d} stages={r['stages']:3d} tasks={r['tasks']:5d} "
              f"stage_s={r['stage_seconds']:7.2f} slowest={r['slowest']}")
