"""Benchmark the headline report queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
prints one JSON line.  Each query is timed end to end (plan building, counts of hinted
sides and the collect) as the minimum of ``$BENCH_RUNS`` warm runs (default 3).

``<query>_refshape`` runs the same query in the original job's shape – one left-join chain per
metric, merged afterwards for the summary – as Spark SQL, for the summary, the spine and every metric.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daytally.plans import fixture_oracle  # noqa: E402
from daytally.plans.queries import queries  # noqa: E402
from daytally.session import get_session  # noqa: E402

HEADLINE = [
    "report_summary", "report_detail", "report_summary_ranked",
    "module_teach", "module_engage", "module_assess", "module_track", "module_analyse", "module_remediate",
    "metric_hook_search", "metric_gocode", "metric_remediate",
    "spine_active_accounts", "report_window", "entities_current_year", "report_backfill",
]
TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]
EXTRA = [f"metric_{m}" for m in (
    "attendance", "teach_studio", "live_assignment", "live_survey", "notifications", "live_class", "case_study",
    "projects", "arena", "objective", "subjective", "coding", "assignment", "regular_feedback",
    "semester_feedback", "unit_feedback", "analyse")] + ["report_backfill_summary"]


def spark_dialect(sql: str) -> str:
    """The oracle's DuckDB SQL as Spark SQL (function spellings and identifier quotes differ)."""
    sql = sql.replace("json_extract_string(", "get_json_object(")
    sql = re.sub(r"AS VARCHAR\)", "AS STRING)", sql)
    return re.sub(r'"(\w+)"', r"`\1`", sql)


def timed(fn, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app="daytally-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})
    qs = queries()
    # Warm the JVM (class loading, codegen caches) once, outside the timings.
    qs["report_summary"](spark, sf_dir).collect()

    times: dict[str, float] = {}
    for key in HEADLINE + EXTRA:
        times[key] = round(timed(lambda: qs[key](spark, sf_dir).collect(), runs), 3)

    summary = qs["report_summary"](spark, sf_dir)
    summary.collect()
    final_plan = summary._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    plan = {"file_scans": len(re.findall(r"FileScan parquet", final_plan)),
            "shuffle_exchanges": len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)",
                                                final_plan)),
            "reused_exchanges": final_plan.count("ReusedExchange")}

    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for key in ["report_summary", "spine_active_accounts", *(k for k in HEADLINE + EXTRA if k.startswith("metric_"))]:
        ref_sql = spark_dialect(fixture_oracle.oracle_sql()[key])
        times[f"{key}_refshape"] = round(timed(lambda: spark.sql(ref_sql).collect(), runs), 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_min_of_runs",
        "value": round(sum(times[k] for k in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "headline": HEADLINE,
        "report_summary_plan": plan,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
