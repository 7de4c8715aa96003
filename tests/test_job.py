from __future__ import annotations

from datetime import date

from daytally.plans.job import run_daily
from daytally.plans.queries import fixture_report
from daytally.sources.jdbc import JdbcConfig, Partitioning, jdbc_options

from .conftest import SF001


def test_daily_job_writes_both_tables_and_reruns_idempotently(spark, scratch_dir):
    rep = fixture_report(spark, SF001)
    paths = run_daily(rep, scratch_dir)
    detail = spark.read.parquet(paths["detail"])
    summary = spark.read.parquet(paths["summary"])
    assert detail.count() == 23 and summary.count() == 24
    assert {r.report_date for r in detail.select("report_date").distinct().collect()} == {date(2024, 1, 16)}
    # Another day lands in its own partition; rerunning the first day replaces only that day.
    run_daily(_on(fixture_report(spark, SF001), date(2024, 1, 17)), scratch_dir)
    run_daily(fixture_report(spark, SF001), scratch_dir)
    detail = spark.read.parquet(paths["detail"])
    assert detail.count() == 46
    assert detail.groupBy("report_date").count().collect()[0]["count"] == 23
    assert spark.sparkContext.getCheckpointDir()


def _on(report, day):
    """The report with its window moved to ``day``."""
    from dataclasses import replace

    from daytally import DailyReport, ReportWindow

    return DailyReport(report.catalog, replace(report.spec, window=ReportWindow.closing_on(day)))


def test_empty_rerun_empties_the_day(spark, scratch_dir):
    from dataclasses import replace

    from daytally import DailyReport

    rep = fixture_report(spark, SF001)
    paths = run_daily(rep, scratch_dir)
    run_daily(_on(rep, date(2024, 1, 17)), scratch_dir)
    none = DailyReport(rep.catalog, replace(rep.spec, allow=()))
    run_daily(none, scratch_dir)
    detail, summary = spark.read.parquet(paths["detail"]), spark.read.parquet(paths["summary"])
    assert [r.report_date for r in detail.select("report_date").distinct().collect()] == [date(2024, 1, 17)]
    assert [r.total for r in summary.where("report_date = DATE'2024-01-16'").collect()] == [0]
    from daytally.plans.job import run_backfill

    run_backfill(none, scratch_dir, 2)
    assert {r.report_date for r in spark.read.parquet(paths["detail"]).collect()} == {date(2024, 1, 17)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


def test_one_zone_for_clock_window_and_database():
    from datetime import datetime, timezone

    from daytally import ReportWindow

    # 22:00 UTC on the 1st is 03:30 on the 2nd at +05:30.
    window = ReportWindow.for_run(datetime(2024, 1, 1, 22, tzinfo=timezone.utc), zone="Asia/Kolkata")
    assert window.end == datetime(2024, 1, 2, 8) and window.zone_offset("Asia/Kolkata") == "+05:30"
    cfg = JdbcConfig(url="jdbc:mysql://db:3306/app", zone_offset=window.zone_offset("Asia/Kolkata"))
    assert jdbc_options(cfg, "notifications")["sessionInitStatement"] == "SET SESSION time_zone = '+05:30'"


def test_cli_options_reach_the_plan(spark, scratch_dir, monkeypatch):
    """Day-partitioned exports prune by partition; a renamed column raises; JDBC settings from flags."""
    import pytest

    from daytally.plans import job
    
    from .test_edge_cases import SCHEMAS

    for name, ddl in SCHEMAS.items():
        df = spark.createDataFrame([], ddl)
        if name == "notifications":
            df.selectExpr("*", "CAST(created_at AS DATE) AS day").unionByName(spark.sql(
                "SELECT 1L AS id, 11L AS college_account_id, TIMESTAMP_NTZ '2024-01-02 07:00:00' AS created_at, DATE '2024-01-02' AS day"
            )).write.partitionBy("day").parquet(f"{scratch_dir}/{name}")
        elif name == "video_conference":
            df.withColumnRenamed("start_time", "begun").write.parquet(f"{scratch_dir}/{name}.parquet")
        else:
            df.write.parquet(f"{scratch_dir}/{name}.parquet")
    zone = spark.conf.get("spark.sql.session.timeZone")
    args = ["--tables", scratch_dir, "--out", "unused", "--report-date", "2024-01-02", "--date-partition", "day",
            "--key-filter-above", "7"]
    report = job.build_report(spark, job._arguments(args))
    spark.conf.set("spark.sql.session.timeZone", zone)
    plan = report.metric("metric_notifications")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "day#" in line)
    assert "PartitionFilters: [isnotnull(day" in scan
    assert report.spec.key_filter_above == 7
    with pytest.raises(ValueError, match="start_time"):
        report.metric("metric_live_class")
    for key in ("DB_HOST", "DB_NAME"):
        monkeypatch.setenv(key, "x")
    report = job.build_report(spark, job._arguments(["--out", "o", "--time-zone", "Asia/Kolkata", "--report-date", "2024-01-02",
                                                     "--jdbc-key-range", "college_account_new:id:1:1000:8"]))
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
    spark.conf.set("spark.sql.session.timeZone", zone)
    opts = jdbc_options(report.catalog.jdbc, "college_account_new")
    assert opts["numPartitions"] == "8" and "+05:30" in opts["sessionInitStatement"]


def test_jdbc_options():
    cfg = JdbcConfig(url="jdbc:mysql://db:3306/app", user="u", password="p",
                     partitioning={"notifications": Partitioning("id", 1, 1_000_000, 64)})
    opts = jdbc_options(cfg, "notifications")
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "64"
    assert opts["pushDownPredicate"] == "true" and opts["user"] == "u"
    assert "partitionColumn" not in jdbc_options(cfg, "college")


def test_cli_on_original_schema_exports(spark, scratch_dir):
    """The production path: Parquet exports of the original tables → CLI → two tables."""
    from daytally.plans import job

    from .test_edge_cases import ROWS, SCHEMAS

    tables = f"{scratch_dir}/exports"
    for name, ddl in SCHEMAS.items():
        spark.createDataFrame(ROWS.get(name, []), ddl).write.parquet(f"{tables}/{name}.parquet")
    out = f"{scratch_dir}/reports"
    job.main(["--tables", tables, "--out", out, "--report-date", "2024-01-02", "--allow", "1,2,3,4,5,6,99"])
    summary = spark.read.parquet(f"{out}/summary").collect()
    assert len(summary) == 7
    by_id = {r["college_id"]: r for r in summary}
    assert by_id["1"]["total"] == 11 and by_id["2"]["total"] == 8 and by_id["-"]["total"] == 20
    detail = spark.read.parquet(f"{out}/detail")
    assert detail.count() == 6 and {r.report_date for r in detail.collect()} == {date(2024, 1, 2)}


def test_jdbc_time_slices_cover_the_closed_window_once():
    from datetime import datetime

    from daytally.sources.jdbc import time_slice_predicates

    preds = time_slice_predicates("created_at", datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8), 4)
    assert preds == [
        "created_at >= '2024-01-01 08:00:00.000000' AND created_at < '2024-01-01 14:00:00.000000'",
        "created_at >= '2024-01-01 14:00:00.000000' AND created_at < '2024-01-01 20:00:00.000000'",
        "created_at >= '2024-01-01 20:00:00.000000' AND created_at < '2024-01-02 02:00:00.000000'",
        "created_at >= '2024-01-02 02:00:00.000000' AND created_at <= '2024-01-02 08:00:00.000000'",
    ]


def test_backfill_job_writes_each_day(spark, scratch_dir):
    from daytally.plans.job import run_backfill

    paths = run_backfill(fixture_report(spark, SF001), scratch_dir, 3)
    detail = spark.read.parquet(paths["detail"])
    summary = spark.read.parquet(paths["summary"])
    days = {date(2024, 1, 16), date(2024, 1, 15), date(2024, 1, 14)}
    assert {r.report_date for r in detail.select("report_date").distinct().collect()} == days
    assert detail.count() == 3 * 23 and summary.count() == 3 * 24
    # The newest day equals the daily job's numbers.
    daily = {r["college_id"]: r["college_usage"] for r in fixture_report(spark, SF001).detail().collect()}
    newest = {r["college_id"]: r["college_usage"] for r in detail.where("report_date = DATE'2024-01-16'").collect()}
    assert newest == daily


def test_written_summary_keeps_report_order(spark, scratch_dir):
    paths = run_daily(fixture_report(spark, SF001), scratch_dir)
    rows = spark.read.parquet(paths["summary"]).collect()  # one file for the day
    assert [r["s_no"] for r in rows] == [str(i) for i in range(1, 24)] + ["Total"]
