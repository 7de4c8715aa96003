"""Report invariants and the published fixture figures (FIXTURES.md), independent of the oracle."""

from __future__ import annotations

import pytest

from daytally.plans.layout import METRIC_LAYOUT, MODULES
from daytally.plans.queries import fixture_report

from .conftest import SF01, SF001

# (sum over entities, entities at 0) per output column, as measured with DuckDB in FIXTURES.md.
EXPECTED = {
    SF001: {"attendance_count": (3, 20), "teach_studio_count": (8, 19), "live_assignment_count": (5, 18),
            "survey_count": (1, 22), "notify_count": (3, 21), "gocode_count": (20, 16), "live_class_count": (8, 16),
            "case_study_count": (4, 20), "projects_count": (2, 21), "arena_count": (1, 22),
            "objective_count": (20, 10), "subjective_count": (6, 18), "coding_count": (5, 19),
            "assignment_count": (9, 16), "regular_feedback_count": (8, 19), "semester_feedback_count": (9, 18),
            "unit_feedback_count": (3, 20), "hook_search_count": (47, 4), "remediate_count": (29, 18),
            "total_analyse": (0, 23)},
    SF01: {"attendance_count": (55, 4), "teach_studio_count": (58, 2), "live_assignment_count": (49, 4),
           "survey_count": (52, 2), "notify_count": (54, 5), "gocode_count": (255, 0), "live_class_count": (27, 7),
           "case_study_count": (36, 4), "projects_count": (19, 13), "arena_count": (28, 8),
           "objective_count": (147, 0), "subjective_count": (53, 1), "coding_count": (37, 4),
           "assignment_count": (56, 2), "regular_feedback_count": (100, 0), "semester_feedback_count": (120, 1),
           "unit_feedback_count": (48, 3), "hook_search_count": (601, 0), "remediate_count": (180, 3),
           "total_analyse": (0, 23)},
}


@pytest.fixture(scope="module", params=[SF001, SF01])
def outputs(request, spark):
    rep = fixture_report(spark, request.param)
    wide = rep.wide()
    return request.param, rep.detail(wide).collect(), rep.summary(wide).collect()


def test_fixture_figures(outputs):
    sf, detail, _ = outputs
    for col, (total, zeros) in EXPECTED[sf].items():
        values = [r[col] for r in detail]
        assert (sum(values), sum(v == 0 for v in values)) == (total, zeros), col


def test_invariants(outputs):
    _, detail, summary = outputs
    assert len(detail) == 23  # allow-list 1..23, all present in nation
    cols = [c for _, _, c in METRIC_LAYOUT]
    for r in detail:
        assert all(r[c] is not None for c in cols)
        assert r["total_analyse"] == 0
        assert r["college_usage"] == sum(r[c] for c in cols)
    body, total = summary[:-1], summary[-1]
    usage = {str(r["college_id"]): r["college_usage"] for r in detail}
    for r in body:
        assert r["total"] == usage[r["college_id"]] == sum(r[m] for m in MODULES)
    assert [r["total"] for r in body] == sorted((r["total"] for r in body), reverse=True)
    assert [r["s_no"] for r in body] == [str(i) for i in range(1, len(body) + 1)]
    assert total["s_no"] == "Total" and total["college_id"] == "-"
    for col in list(MODULES) + ["total"]:
        assert total[col] == sum(r[col] for r in body)
