"""Both report tables are replaced together, whatever fails in between."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date

import pytest

from daytally import DailyReport, ReportWindow
from daytally.plans import job
from daytally.plans.queries import fixture_report
from daytally.sources import Staged, publish, sinks

from .conftest import SF001


def tables(spark, out):
    return [sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in ("detail", "summary")]


def other(spark):
    """A report of the same day with other numbers."""
    rep = fixture_report(spark, SF001)
    return DailyReport(rep.catalog, replace(rep.spec, allow=(1, 2, 3)))


def test_failure_between_the_writes_leaves_the_old_day(spark, scratch_dir, monkeypatch):
    job.run_daily(fixture_report(spark, SF001), scratch_dir)
    before = tables(spark, scratch_dir)
    real, calls = sinks.write_partitioned, []

    def failing(df, path, *args, **kw):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(df, path, *args, **kw)

    monkeypatch.setattr(job, "write_partitioned", failing)
    with pytest.raises(RuntimeError, match="lost"):
        job.run_daily(other(spark), scratch_dir)
    assert len(calls) == 2 and tables(spark, scratch_dir) == before
    assert os.listdir(f"{scratch_dir}/_staged") == []
    monkeypatch.undo()
    job.run_daily(other(spark), scratch_dir)
    assert [len(t) for t in tables(spark, scratch_dir)] == [3, 4]


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_a_committed_run_is_finished_by_the_next(spark, scratch_dir, monkeypatch, moves):
    job.run_daily(fixture_report(spark, SF001), scratch_dir)
    real, done = sinks._move, []

    def failing(fs, source, target):
        if len(done) == moves:
            raise OSError("lost")
        done.append(1)
        real(fs, source, target)

    monkeypatch.setattr(sinks, "_move", failing)
    with pytest.raises(OSError, match="lost"):
        job.run_daily(other(spark), scratch_dir)
    monkeypatch.undo()
    assert len(publish(spark, scratch_dir)) == 1
    assert [len(t) for t in tables(spark, scratch_dir)] == [3, 4]
    assert publish(spark, scratch_dir) == [] and os.listdir(f"{scratch_dir}/_staged") == []


def test_abandoned_runs_are_not_published(spark, scratch_dir):
    one = spark.createDataFrame([(1,)], "x int")
    staged = Staged(spark, scratch_dir, ["detail"]).__enter__()  # its process ends here
    sinks.write_partitioned(one, staged.path("detail"), date(2024, 1, 1))
    with Staged(spark, scratch_dir, ["detail"]) as late:
        sinks.write_partitioned(one.selectExpr("x + 1 AS x"), late.path("detail"), date(2024, 1, 2))
        with pytest.raises(KeyError):
            late.path("summary")
    assert [(r.x, r.report_date) for r in spark.read.parquet(f"{scratch_dir}/detail").collect()] == [(2, date(2024, 1, 2))]
    assert os.listdir(f"{scratch_dir}/_staged") == [staged.run]


def test_backfill_replaces_its_days_together(spark, scratch_dir, monkeypatch):
    rep = fixture_report(spark, SF001)
    job.run_backfill(rep, scratch_dir, 3)
    before = tables(spark, scratch_dir)
    assert [len(t) for t in before] == [3 * 23, 3 * 24]
    earlier = DailyReport(rep.catalog, replace(rep.spec, window=ReportWindow.closing_on(date(2024, 1, 10))))
    job.run_daily(earlier, scratch_dir)
    assert [len(t) for t in tables(spark, scratch_dir)] == [4 * 23, 4 * 24]
    job.run_backfill(rep, scratch_dir, 3)
    after = tables(spark, scratch_dir)
    assert [len(t) for t in after] == [4 * 23, 4 * 24] and all(set(b) <= set(a) for a, b in zip(after, before, strict=True))
