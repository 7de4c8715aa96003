"""Edge cases the fixtures cannot show, on small frames in the original schema.

Window under test: [2024-01-01 08:00, 2024-01-02 08:00], both ends inclusive.
"""

from __future__ import annotations

from datetime import date, datetime

import pytest

from daytally import Catalog, DailyReport, ReportWindow
from daytally.plans import reference_schema

IN = datetime(2024, 1, 1, 12, 0, 0)
WINDOW = ReportWindow.closing_on(date(2024, 1, 2))
ALLOW = (1, 2, 3, 4, 5, 6, 99)

SCHEMAS = {
    "college": "id INT, college_name STRING",
    "college_university_degree_department_new": "id INT, college_id INT",
    "college_account_new": "id BIGINT, college_university_degree_department_id INT, dummy INT",
    "faculty_class_hours": "id BIGINT, faculty_id BIGINT, entry_date TIMESTAMP_NTZ",
    "college_account_co_pilot_search": "id BIGINT, college_account_id BIGINT",
    "co_pilot_hook_search": "id BIGINT, college_account_co_pilot_search_id BIGINT, date_of_search TIMESTAMP_NTZ",
    "co_pilot_lesson_plans": "id BIGINT, college_account_id BIGINT, created_at TIMESTAMP_NTZ",
    "questionnaire_live": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ",
    "live_surveys": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ",
    "notifications": "id BIGINT, college_account_id BIGINT, created_at TIMESTAMP_NTZ",
    "video_conference": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ",
    "case_study_assignments": "id BIGINT, college_account_id BIGINT, start_date DATE",
    "academic_projects": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ",
    "weekly_challenge": "id BIGINT, college_account_id BIGINT, start_date DATE",
    "college_account_coding_track_question_submissions":
        "question_id BIGINT, college_account_id BIGINT, created_at TIMESTAMP_NTZ",
    "questionnaire": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ, remedial_path INT",
    "questionnaire_subjective": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ, is_assignment INT",
    "coding_test": "id BIGINT, college_account_id BIGINT, start_time TIMESTAMP_NTZ",
    "survey": "id BIGINT, faculty_id BIGINT, created_at TIMESTAMP_NTZ",
    "semester_feedback": "id BIGINT, faculty_id BIGINT, created_at TIMESTAMP_NTZ",
    "faculty_feedback": "id BIGINT, college_account_id BIGINT, created_at TIMESTAMP_NTZ",
    "questionnaire_remedial_path": "id BIGINT, questionnaire_id BIGINT",
}

# Accounts: 11, 12 real and 13 dummy in college 1; 21 real in college 2; 51 only dummy in
# college 5; 61 real in college 6 (NULL name).  College 3 has no department, 4 has no account.
ROWS = {
    "college": [(1, "Alpha"), (2, "Beta"), (3, "Gamma"), (4, "Delta"), (5, "Eps"), (6, None), (7, "Zeta")],
    "college_university_degree_department_new": [(10, 1), (20, 2), (40, 4), (50, 5), (60, 6), (70, 7)],
    "college_account_new": [(11, 10, 0), (12, 10, 0), (13, 10, 1), (21, 20, 0), (51, 50, 1), (61, 60, 0),
                            (62, 60, None), (71, 70, 0)],
    "faculty_class_hours": [
        (1, 11, datetime(2024, 1, 1, 8, 0, 0)),    # on the lower bound: in
        (2, 11, datetime(2024, 1, 2, 8, 0, 0)),    # on the upper bound: in (and in the next report)
        (3, 11, datetime(2024, 1, 1, 7, 59, 59)),  # out
        (4, 12, datetime(2024, 1, 2, 8, 0, 1)),    # out
        (5, 12, None),                             # out
        (6, 13, IN),                               # dummy account: out
        (7, 21, IN), (8, 61, IN), (9, 62, IN),     # 62 has a NULL flag: not a real account
        (10, 71, IN),                              # college 7 is not allow-listed
    ],
    "college_account_co_pilot_search": [(100, 11), (101, 13), (102, 51)],
    "co_pilot_hook_search": [(1, 100, IN), (2, 100, IN), (3, 101, IN), (4, 102, IN)],
    "co_pilot_lesson_plans": [(1, 21, IN)],
    "case_study_assignments": [(1, 11, date(2024, 1, 2)), (2, 11, date(2024, 1, 1))],
    "college_account_coding_track_question_submissions": [(10, 11, IN), (10, 12, IN), (11, 21, IN), (11, 21, IN),
                                                          (None, 21, IN)],
    "questionnaire": [(1, 11, IN, 1), (2, 11, IN, 1), (3, 21, IN, 1), (4, 21, IN, 0),
                      (5, 11, datetime(2023, 12, 1), 1)],
    "questionnaire_remedial_path": [(1, 2), (2, 3), (3, 3), (4, 3), (5, 4), (6, 4), (7, 5), (None, 2)],
    "questionnaire_subjective": [(1, 11, IN, 0), (2, 11, IN, 1), (3, 11, IN, None)],
}


def _catalog(spark, rows=None):
    rows = {**ROWS, **(rows or {})}
    return Catalog.in_memory(spark, {name: spark.createDataFrame(rows.get(name, []), ddl)
                                     for name, ddl in SCHEMAS.items()})


@pytest.fixture(scope="module")
def report(spark):
    return DailyReport(_catalog(spark), reference_schema.report_spec(WINDOW, allow=ALLOW))


def _by_id(df, col):
    return {r["college_id"]: r[col] for r in df.collect()}


def test_closed_window_and_account_filters(report):
    got = _by_id(report.metric("metric_attendance"), "attendance_count")
    assert got == {1: 2, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_event_on_the_cut_is_in_the_next_report_too(spark):
    nxt = DailyReport(_catalog(spark), reference_schema.report_spec(
        ReportWindow.closing_on(date(2024, 1, 3)), allow=ALLOW))
    assert _by_id(nxt.metric("metric_attendance"), "attendance_count")[1] == 2  # rows 2 and 4


def test_date_column_compares_as_midnight(report):
    assert _by_id(report.metric("metric_case_study"), "case_study_count")[1] == 1


def test_null_flag_is_in_neither_split(report):
    assert _by_id(report.metric("metric_subjective"), "subjective_count")[1] == 1
    assert _by_id(report.metric("metric_assignment"), "assignment_count")[1] == 1


def test_distinct_non_key_across_accounts(report):
    got = _by_id(report.metric("metric_gocode"), "gocode_count")
    assert got[1] == 1 and got[2] == 1


def test_pair_count_keeps_fan_out(report):
    got = _by_id(report.metric("metric_remediate"), "remediate_count")
    assert got[1] == 1 and got[2] == 3  # 0 + 1 paths; 3 paths; the non-remedial one is not counted
    assert _by_id(report.metric("metric_objective"), "objective_count") == {1: 2, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0}


def test_where_form_drops_entities_without_real_account(report):
    hook = _by_id(report.metric("metric_hook_search"), "hook_search_count")
    assert hook == {1: 2, 2: 0, 6: 0}
    studio = _by_id(report.metric("metric_teach_studio"), "teach_studio_count")
    assert studio == {1: 0, 2: 1, 6: 0}
    teach = report.module("teach").collect()
    assert {r["college_id"] for r in teach} == {1, 2, 3, 4, 5, 6}
    assert {r["college_id"]: r["hook_search_count"] for r in teach}[5] == 0


def test_null_name_becomes_zero_in_reports(report):
    assert {r["college_id"]: r["college_name"] for r in report.metric("metric_attendance").collect()}[6] is None
    detail = {r["college_id"]: r for r in report.detail().collect()}
    assert detail[6]["college_name"] == "0"


def test_spine_keeps_entities_without_accounts(report):
    rows = report.spine_active_accounts().collect()
    by = {}
    for r in rows:
        by.setdefault(r["college_id"], []).append(r["account_id"])
    assert sorted(by[1]) == [11, 12]
    assert by[3] == [None] and by[4] == [None] and by[5] == [None]
    assert 99 not in by and 7 not in by


def test_detail_and_summary(report):
    detail = report.detail().collect()
    assert [r["s_no"] for r in detail] == list(range(1, 7))
    assert [r["college_id"] for r in detail] == [1, 2, 3, 4, 5, 6]
    usage = {r["college_id"]: r["college_usage"] for r in detail}
    assert usage == {1: 11, 2: 8, 3: 0, 4: 0, 5: 0, 6: 1}

    summary = report.summary().collect()
    assert [r["college_id"] for r in summary] == ["1", "2", "6", "3", "4", "5", "-"]  # ties by id
    assert [r["s_no"] for r in summary] == ["1", "2", "3", "4", "5", "6", "Total"]
    first = summary[0]
    assert (first["teach"], first["engage"], first["assess"], first["track"], first["analyse"],
            first["remediate"], first["total"]) == (4, 2, 4, 0, 0, 1, 11)
    total = summary[-1]
    assert total["college_name"] == "Overall Total"
    for col in ("teach", "engage", "assess", "track", "analyse", "remediate", "total"):
        assert total[col] == sum(r[col] for r in summary[:-1])


def test_repeated_bridge_rows_multiply_pairs_not_distinct_counts(spark):
    dup = ROWS["college_university_degree_department_new"] + [(20, 2)]
    rep = DailyReport(_catalog(spark, {"college_university_degree_department_new": dup}),
                      reference_schema.report_spec(WINDOW, allow=ALLOW))
    assert _by_id(rep.metric("metric_remediate"), "remediate_count")[2] == 6
    assert _by_id(rep.metric("metric_objective"), "objective_count")[2] == 2


def test_empty_allow_list(spark):
    rep = DailyReport(_catalog(spark), reference_schema.report_spec(WINDOW, allow=()))
    assert rep.detail().count() == 0
    summary = rep.summary().collect()
    assert len(summary) == 1 and summary[0]["s_no"] == "Total" and summary[0]["total"] == 0


def test_shuffle_fallback_when_broadcast_bound_is_exceeded(spark, report):
    """With a zero row bound and no automatic broadcast everything shuffles; the numbers must not change."""
    want = report.detail().collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rep = DailyReport(_catalog(spark), reference_schema.report_spec(WINDOW, allow=ALLOW, key_filter_above=0))
    df = rep.detail()
    assert df.collect() == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_backfill_equals_the_daily_runs(spark, report):
    """Three daily reports in one pass equal three separate daily runs (rows on a cut count twice)."""
    back = report.backfill_detail(3).collect()
    assert len(back) == 3 * 6
    for k in range(3):
        day = date(2024, 1, 2 - k) if k < 2 else date(2023, 12, 31)
        daily = DailyReport(_catalog(spark), reference_schema.report_spec(ReportWindow.closing_on(day), allow=ALLOW))
        want = [r.asDict() for r in daily.detail().collect()]
        got = [{key: v for key, v in r.asDict().items() if key != "report_date"}
               for r in back if r["report_date"] == day.isoformat()]
        assert got == want, day
    # The event at 2024-01-01 08:00:00 is in the reports of 2024-01-02 and 2024-01-01.
    by_day = {(r["report_date"], r["college_id"]): r["attendance_count"] for r in back}
    assert by_day[("2024-01-02", 1)] == 2 and by_day[("2024-01-01", 1)] == 2


def test_entities_current_year_inner_chain(spark):
    """Dormant query of the original: DISTINCT colleges with a department mapped to the current year."""
    frames = {
        "academic_years": spark.createDataFrame([(1, "2024-25", 1), (2, "2023-24", 0)],
                                                "id INT, name STRING, current_academic_year INT"),
        "college_academic_years": spark.createDataFrame(
            [(1, 100), (1, 101), (2, 102), (1, 103)], "academic_year_id INT, regulation_batch_mapping_id INT"),
        "regulation_batch_mapping": spark.createDataFrame([(100, 500), (101, 501), (102, 502), (103, 503)],
                                                          "id INT, regulation_mapping_id INT"),
        "regulation_mappings": spark.createDataFrame([(500, 10), (501, 10), (502, 20), (503, 99)],
                                                     "id INT, cudd_id INT"),
        "college_university_degree_department_new": spark.createDataFrame(
            ROWS["college_university_degree_department_new"], SCHEMAS["college_university_degree_department_new"]),
        "college": spark.createDataFrame(ROWS["college"], SCHEMAS["college"]),
    }
    got = reference_schema.entities_current_year(Catalog.in_memory(spark, frames)).collect()
    # Two mappings reach department 10 (college 1) in the current year: one row; 20 is last year; 99 has no department.
    assert [tuple(r) for r in got] == [(1, "Alpha", "2024-25")]


def test_backfill_summary_equals_the_daily_summaries(spark, report):
    back = report.backfill_summary(2).collect()
    for k, day in enumerate((date(2024, 1, 2), date(2024, 1, 1))):
        daily = DailyReport(_catalog(spark), reference_schema.report_spec(ReportWindow.closing_on(day), allow=ALLOW))
        want = [r.asDict() for r in daily.summary().collect()]
        got = [{key: v for key, v in r.asDict().items() if key != "report_date"}
               for r in back if r["report_date"] == day.isoformat()]
        assert got == want, day


def test_repeated_account_row_keeps_distinct_counts(spark):
    """An account listed twice reaches its college twice: ids are still counted once, pairs twice."""
    accounts = ROWS["college_account_new"] + [(11, 10, 0)]
    rep = DailyReport(_catalog(spark, {"college_account_new": accounts}),
                      reference_schema.report_spec(WINDOW, allow=ALLOW))
    assert _by_id(rep.metric("metric_attendance"), "attendance_count")[1] == 2
    assert _by_id(rep.metric("metric_remediate"), "remediate_count")[1] == 2
