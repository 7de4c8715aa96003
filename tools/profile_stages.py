"""Stage timings of one registered query from Spark's event log (no UI).

Usage: python tools/profile_stages.py <query key> [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daytally.plans.queries import queries  # noqa: E402
from daytally.session import get_session  # noqa: E402


def main() -> None:
    key = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                              "spark.eventLog.compress": "false"})
    fn = queries()[key]
    fn(spark, sf_dir).collect()  # warm
    t0 = time.time()
    fn(spark, sf_dir).collect()
    print(f"{key}: {time.time() - t0:.2f}s (warm)")
    spark.stop()
    stages = {}
    jobs = {}
    for path in glob.glob(f"{logdir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"], info["Stage Name"][:60],
                                            info["Number of Tasks"],
                                            acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                                            acc.get("internal.metrics.input.recordsRead", 0))
            elif kind == "SparkListenerJobStart":
                jobs[ev["Job ID"]] = ev["Stage IDs"]
    # Only the second (warm) run: the upper half of the job ids.
    ids = sorted(jobs)
    warm = ids[len(ids) // 2:]
    total = 0
    for j in warm:
        for s in jobs[j]:
            if s in stages:
                d, name, ntasks, shuf, recs = stages[s]
                total += d
                print(f"job {j:3d} stage {s:3d} {d:6d}ms tasks={ntasks:3d} shuffle_w={shuf:>10} in_recs={recs:>9} {name}")
    print("sum of stage ms", total)


if __name__ == "__main__":
    main()
