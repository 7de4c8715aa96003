"""The daily job: measure once, write the detail and summary tables for the report date.

The per-entity measurement is small (one row per allow-listed entity) but is the end of
the whole plan.  It is checkpointed reliably into the cluster's ``spark.checkpoint.dir`` so
both tables are written from the same numbers, and a lost executor during the second
write does not re-run the fact scans.  Both are staged and published under one marker: a run that fails
before it leaves the days as they were, one that fails after it is finished by the next run.

Command line (original schema, Parquet exports or JDBC)::

    python -m daytally.plans.job --tables s3a://bucket/exports --out s3a://bucket/reports \\
        [--report-date 2024-01-16] [--time-zone Asia/Kolkata] [--cut-hour 8] [--allow 9,21,27] \\
        [--date-partition day] [--backfill-days 30] [--state s3a://bucket/states]
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..functions.window import CUT_HOUR, ReportWindow
from ..operators import daystate
from ..operators.report import DailyReport
from ..session import ensure_checkpoint_dir, get_session
from ..sources.catalog import Catalog
from ..sources.jdbc import JdbcConfig, Partitioning
from ..sources.sinks import DETAIL_ORDER, SUMMARY_ORDER, Staged, write_partitioned
from . import reference_schema


TABLES = ("detail", "summary")


def run_daily(report: DailyReport, out_dir: str) -> dict[str, str]:
    spark = report.catalog.spark
    ensure_checkpoint_dir(spark)
    day = report.spec.window.report_date
    wide = report.wide().checkpoint(eager=True)
    with Staged(spark, out_dir, TABLES) as staged:
        write_partitioned(report.detail(wide), staged.path("detail"), day, order_by=DETAIL_ORDER)
        write_partitioned(report.summary(wide), staged.path("summary"), day, order_by=SUMMARY_ORDER)
    return {t: f"{out_dir}/{t}" for t in TABLES}


def run_backfill(report: DailyReport, out_dir: str, days: int) -> dict[str, str]:
    """The daily job for ``days`` consecutive report days (the latest is the report's own day),
    measured in one pass over the facts; each day lands in (and replaces) its own partition."""
    return _write_days(report, report.wide(runs=days), out_dir, days)


def run_merged(report: DailyReport, out_dir: str, state_dir: str, days: int = 1) -> dict[str, str]:
    """The same from day states kept in ``state_dir``: days that are not there yet are measured and added,
    the others are not read again."""
    daystate.write_states(report, state_dir, days)
    return _write_days(report, daystate.report_wide(report, daystate.read_states(report, state_dir), days), out_dir, days)


def _write_days(report: DailyReport, wide: DataFrame, out_dir: str, days: int) -> dict[str, str]:
    spark = report.catalog.spark
    ensure_checkpoint_dir(spark)
    wide = wide.checkpoint(eager=True)
    every = [report.spec.window.report_date - timedelta(days=k) for k in range(days)]
    with Staged(spark, out_dir, TABLES) as staged:
        write_partitioned(report.backfill_detail(days, wide), staged.path("detail"), every, order_by=DETAIL_ORDER)
        write_partitioned(report.backfill_summary(days, wide), staged.path("summary"), every, order_by=SUMMARY_ORDER)
    return {t: f"{out_dir}/{t}" for t in TABLES}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description="Daily activity report")
    ap.add_argument("--tables", help="folder of table exports (<name>.parquet); omit to read over JDBC")
    ap.add_argument("--out", required=True)
    ap.add_argument("--report-date", help="YYYY-MM-DD; default: today in --time-zone")
    ap.add_argument("--time-zone", default="UTC",
                    help="zone of the fact times, the report day and the cut hour (also of the database session)")
    ap.add_argument("--cut-hour", type=int, default=CUT_HOUR)
    ap.add_argument("--lookback-days", type=int, default=1)
    ap.add_argument("--allow", help="comma-separated entity ids; default: the original allow-list")
    ap.add_argument("--backfill-days", type=int, default=1,
                    help="write this many consecutive report days ending at --report-date, in one pass")
    ap.add_argument("--state", help="folder of day states: measure the days that it lacks, merge the windows from it")
    ap.add_argument("--date-partition", help="DATE partition column of day-partitioned fact exports")
    ap.add_argument("--key-filter-above", type=int, default=64 << 20,
                    help="estimated bytes of an unwindowed table from which its scan is reduced to the window's keys; 0: always")
    ap.add_argument("--key-filter-bits", type=int, default=1 << 23, help="bits of that reduction's bitmap")
    ap.add_argument("--jdbc-time-slices", type=int, default=16,
                    help="JDBC only: parallel time-range queries per windowed fact table")
    ap.add_argument("--jdbc-key-range", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:PARTITIONS",
                    help="JDBC only: read an unwindowed table by these ranges of a numeric key; repeatable")
    ap.add_argument("--jdbc-rows-per-range", type=int, default=1_000_000,
                    help="JDBC only: keys in a range of the other unwindowed tables, between bounds that one query asks for")
    ap.add_argument("--jdbc-instants", action="append", default=[], metavar="TABLE",
                    help="JDBC only: this fact table's time column holds instants (rendered in the session's zone), not "
                         "wall-clock time; a window over a clock change is then read by one session per offset; repeatable")
    ap.add_argument("--jdbc-max-ranges", type=int, default=64, help="JDBC only: such ranges of a table at most")
    return ap.parse_args(argv)


def _fact_tables(names: list[str]) -> frozenset[str]:
    unknown = set(names) - {s.table for s in reference_schema.SOURCES}
    if unknown:
        raise ValueError(f"not fact tables: {', '.join(sorted(unknown))}")
    return frozenset(names)


def build_report(spark: SparkSession, args: argparse.Namespace) -> DailyReport:
    """The report that the command line asks for."""
    allow = tuple(int(x) for x in args.allow.split(",") if x.strip()) if args.allow is not None \
        else reference_schema.ALLOW_LIST
    lookback = timedelta(days=args.lookback_days)
    window = (ReportWindow.closing_on(date.fromisoformat(args.report_date), args.cut_hour, lookback) if args.report_date
              else ReportWindow.for_run(cut_hour=args.cut_hour, lookback=lookback, zone=args.time_zone))
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    if args.tables:
        catalog = Catalog.parquet_dir(spark, args.tables, columns=reference_schema.COLUMNS, kinds=reference_schema.KINDS)
    else:
        ranges = {t: Partitioning(c, int(lo), int(hi), int(n))
                  for t, c, lo, hi, n in (r.split(":") for r in args.jdbc_key_range)}
        catalog = Catalog(spark, jdbc=JdbcConfig.mysql_from_env(
            time_slices=args.jdbc_time_slices, partitioning=ranges, keys=reference_schema.JDBC_KEYS,
            rows_per_range=args.jdbc_rows_per_range, max_ranges=args.jdbc_max_ranges, zone_offset=window.zone_offset(args.time_zone),
            zone=args.time_zone, instants=_fact_tables(args.jdbc_instants)))
    return DailyReport(catalog, reference_schema.report_spec(
        window, allow=allow, date_partition=args.date_partition,
        key_filter_above=args.key_filter_above, key_filter_bits=args.key_filter_bits))


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    report = build_report(get_session(), args)
    if args.state:
        run_merged(report, args.out, args.state, args.backfill_days)
    elif args.backfill_days > 1:
        run_backfill(report, args.out, args.backfill_days)
    else:
        run_daily(report, args.out)


if __name__ == "__main__":
    main()
