"""Summarise a Spark event log per job description (bench sets it to the
query name): jobs, stages, tasks, input, shuffle write / read, task time.

    BENCH_EVENT_LOG=/tmp/ev BENCH_RUNS=1 python bench.py
    python tools/stage_report.py /tmp/ev/eventlog_v2_<app-id>  [--out docs/STAGES.md]
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a file (plain or .zstd) or a rolling log folder."""
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for name in files:
        if name.endswith(".zstd"):
            import zstandard

            with open(name, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(name, encoding="utf-8") as f:
                yield from f


def summarise(path: str) -> dict[str, dict[str, float]]:
    stage_desc: dict[int, str] = {}
    jobs: dict[str, set] = defaultdict(set)
    stages: dict[str, set] = defaultdict(set)
    totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    current = "(none)"
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description") or "(none)"
            if "runId =" in desc:  # a streaming micro-batch: count it for the query that started it
                desc = current
            else:
                current = desc
            jobs[desc].add(ev["Job ID"])
            for sid in ev.get("Stage IDs", []):
                stage_desc[sid] = desc
        elif kind == "SparkListenerTaskEnd":
            desc = stage_desc.get(ev["Stage ID"], "(none)")
            stages[desc].add(ev["Stage ID"])
            m = ev.get("Task Metrics") or {}
            t = totals[desc]
            t["tasks"] += 1
            t["task_ms"] += m.get("Executor Run Time", 0)
            t["input_mb"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0) / 2**20
            t["shuffle_write_mb"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0) / 2**20
            r = m.get("Shuffle Read Metrics") or {}
            t["shuffle_read_mb"] += (r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)) / 2**20
    for desc in totals:
        totals[desc]["jobs"] = len(jobs[desc])
        totals[desc]["stages"] = len(stages[desc])
    return totals


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("event_log")
    ap.add_argument("--out", default=None)
    args = ap.parse_args()
    totals = summarise(args.event_log)
    lines = [
        "| query | jobs | stages | tasks | input MB | shuffle write MB | shuffle read MB | task time s |",
        "| --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for desc, t in totals.items():
        lines.append(
            f"| `{desc}` | {int(t['jobs'])} | {int(t['stages'])} | {int(t['tasks'])} | {t['input_mb']:.1f} | "
            f"{t['shuffle_write_mb']:.2f} | {t['shuffle_read_mb']:.2f} | {t['task_ms'] / 1000:.1f} |"
        )
    text = "\n".join(lines)
    print(text)
    if args.out:
        with open(args.out, "w") as f:
            f.write(
                "# Stage summary per query\n\nFrom Spark's event log of one `bench.py` pass "
                "(warm-up plus timed runs, all counted) by `tools/stage_report.py`.\n\n" + text + "\n"
            )


if __name__ == "__main__":
    main()
