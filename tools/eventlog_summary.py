"""Summarize a Spark event log folder: job and stage wall times.

Usage: python tools/eventlog_summary.py <eventlog dir> [min_stage_sec]
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        yield from io.StringIO(data.decode())
    else:
        yield from open(path)


def main(argv):
    root = argv[1]
    min_s = float(argv[2]) if len(argv) > 2 else 0.25
    files = sorted(p for p in glob.glob(f"{root}/**/events_*", recursive=True))
    stages, jobs = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"][:70])
            elif ev == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                jobs[e["Job ID"]] = [e["Submission Time"], None, f"{e.get('Stage IDs')} {desc}"]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
    for k, (d, n, name) in sorted(stages.items()):
        if d >= min_s:
            print(f"stage {k:4d} {d:7.2f}s tasks={n:5d} {name}")
    print("sum of stage time", round(sum(v[0] for v in stages.values()), 2))
    t0 = min((s for s, _, _ in jobs.values()), default=0)
    for k, (s, e, st) in sorted(jobs.items()):
        if e and (e - s) / 1000 >= min_s:
            print(f"job {k:4d} at {(s - t0) / 1000:7.2f}s took {(e - s) / 1000:6.2f}s stages={st}")


if __name__ == "__main__":
    main(sys.argv)
