"""Day states: windows merged from measured days equal windows measured at once."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

import pytest

from daytally import DailyReport, ReportWindow
from daytally.operators import daystate
from daytally.plans import job, reference_schema
from daytally.plans.queries import fixture_report, queries

from .conftest import SF001
from .test_edge_cases import ALLOW, _catalog


def rows(df):
    return sorted(map(str, df.collect()))


def test_fixture_report_from_states(spark):
    rep = fixture_report(spark, SF001)
    state = daystate.states(rep)
    assert rows(rep.detail(daystate.report_wide(rep, state))) == rows(rep.detail())
    assert rows(queries()["report_backfill_merged"](spark, SF001)) == rows(rep.backfill_detail(7))


KEYS = ("metric_attendance", "metric_hook_search", "metric_gocode", "metric_subjective", "metric_assignment", "metric_remediate")


def reference(spark, day, days=1):
    spec = reference_schema.report_spec(ReportWindow.closing_on(day, lookback=timedelta(days=days)), allow=ALLOW)
    return DailyReport(_catalog(spark), replace(spec, metrics=tuple(m for m in spec.metrics if m.key in KEYS)))


@pytest.mark.parametrize("days", [1, 3])
def test_rows_on_the_cuts_count_once(spark, days):
    """The reference's own tables, with rows exactly on the cuts, over one to three days."""
    rep = reference(spark, date(2024, 1, 2), days)
    assert rows(rep.detail(daystate.report_wide(rep, daystate.states(rep)))) == rows(rep.detail())
    back = rep.backfill_detail(2, daystate.report_wide(rep, daystate.states(rep, 2), 2))
    assert rows(back) == rows(rep.backfill_detail(2))


def test_states_are_kept_and_only_missing_days_are_measured(spark, scratch_dir):
    path = f"{scratch_dir}/states"
    first, last = reference(spark, date(2024, 1, 1)), reference(spark, date(2024, 1, 2))
    added = daystate.write_states(first, path)
    assert set(added["class_hours"]) == {date(2024, 1, 1)}
    wide = reference(spark, date(2024, 1, 2), 3)
    added = daystate.write_states(wide, path)
    assert set(added["class_hours"]) == {date(2024, 1, 2), date(2023, 12, 31)}
    assert daystate.write_states(last, path) == {}
    state = daystate.read_states(last, path)
    for rep in (last, wide):
        assert rows(rep.summary(daystate.report_wide(rep, state))) == rows(rep.summary())
    # What is kept answers without the facts.
    plan = daystate.merged_wide(wide, state)._jdf.queryExecution().executedPlan().toString()
    assert "states" in plan and "entry_date" not in plan


def test_job_from_states(spark, scratch_dir):
    rep = reference(spark, date(2024, 1, 2))
    paths = job.run_merged(rep, f"{scratch_dir}/merged", f"{scratch_dir}/states", 2)
    job.run_backfill(rep, f"{scratch_dir}/scanned", 2)
    for table, path in paths.items():
        assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(f"{scratch_dir}/scanned/{table}"))


def test_no_activity_and_half_days(spark):
    empty = reference(spark, date(2030, 1, 1))
    assert rows(empty.detail(daystate.report_wide(empty, daystate.states(empty)))) == rows(empty.detail())
    spec = replace(empty.spec, window=ReportWindow.closing_on(date(2024, 1, 2), lookback=timedelta(hours=36)))
    with pytest.raises(ValueError, match="whole days"):
        daystate.states(DailyReport(empty.catalog, spec))
