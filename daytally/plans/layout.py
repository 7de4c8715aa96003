"""Layout of the daily activity report: modules, metric keys and output columns.

These are fixed values of the original report and must stay exactly as they are so that
outputs line up column for column.
"""

from __future__ import annotations

# Module order of the summary.
MODULES = ("teach", "engage", "assess", "track", "analyse", "remediate")

# Fixed values: (query key, module, output column), in the detail table's column order.
METRIC_LAYOUT = (
    ("metric_attendance", "teach", "attendance_count"),
    ("metric_hook_search", "teach", "hook_search_count"),
    ("metric_teach_studio", "teach", "teach_studio_count"),
    ("metric_live_assignment", "engage", "live_assignment_count"),
    ("metric_live_survey", "engage", "survey_count"),
    ("metric_notifications", "engage", "notify_count"),
    ("metric_live_class", "engage", "live_class_count"),
    ("metric_case_study", "engage", "case_study_count"),
    ("metric_projects", "engage", "projects_count"),
    ("metric_arena", "engage", "arena_count"),
    ("metric_gocode", "engage", "gocode_count"),
    ("metric_objective", "assess", "objective_count"),
    ("metric_subjective", "assess", "subjective_count"),
    ("metric_coding", "assess", "coding_count"),
    ("metric_assignment", "assess", "assignment_count"),
    ("metric_regular_feedback", "track", "regular_feedback_count"),
    ("metric_semester_feedback", "track", "semester_feedback_count"),
    ("metric_unit_feedback", "track", "unit_feedback_count"),
    ("metric_analyse", "analyse", "total_analyse"),
    ("metric_remediate", "remediate", "remediate_count"),
)

# The entity allow-list of the original report.
ALLOW_LIST = (9, 21, 27, 28, 29, 32, 36, 40, 41, 64, 65, 66, 67, 68, 69, 70, 71, 72, 73, 74, 75, 76, 77)

MODULE_OF = {key: module for key, module, _ in METRIC_LAYOUT}
COLUMN_OF = {key: column for key, _, column in METRIC_LAYOUT}
