"""Per-stage task balance from a Spark event log (skew check without the UI).

Usage:
    spark = SparkSession.builder.config("spark.eventLog.enabled", "true")
                                .config("spark.eventLog.dir", "/tmp/run-xxx/events") ...
    ... run queries, stop the session ...
    python tools/task_balance.py /tmp/run-xxx/events

Prints, for every stage with more than one task and a slowest task over 150 ms,
the task count, the slowest and the median task time, and the largest and
median number of shuffle records read — a hot key shows up as max >> median.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        data = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read()
    return data.decode().splitlines()


def main(log_dir: str) -> None:
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)]
    files += [f for f in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(f) and "appstatus" not in f]
    tasks: dict[int, list[tuple[int, int]]] = {}
    for f in files:
        for line in _lines(f):
            if not line.strip():
                continue
            e = json.loads(line)
            if e.get("Event") != "SparkListenerTaskEnd":
                continue
            info, metrics = e["Task Info"], e.get("Task Metrics") or {}
            read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"], read))
    for sid, ts in sorted(tasks.items()):
        d = [t for t, _ in ts]
        r = [x for _, x in ts]
        if len(d) > 1 and max(d) > 150:
            print(
                f"stage {sid}: tasks {len(d)}  time max {max(d)} ms / median {statistics.median(d):.0f} ms  "
                f"records max {max(r)} / median {statistics.median(r):.0f}"
            )


if __name__ == "__main__":
    main(sys.argv[1])
