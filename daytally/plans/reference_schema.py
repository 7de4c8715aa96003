"""The report declared over the original relational schema (colleges, departments, accounts).

This is the registry a production run uses, reading the same tables the original job read,
through Parquet exports or JDBC (see :mod:`daytally.sources`).  Table and column names are
fixed values of that schema.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.window import ReportWindow
from ..operators.specs import CONSTANT, PAIRS, Child, Header, Metric, ReportSpec, Source, SpineSpec
from ..sources.catalog import Catalog
from .layout import ALLOW_LIST, COLUMN_OF, MODULE_OF, MODULES

SPINE = SpineSpec(
    entity_table="college", entity_id="id", entity_name="college_name",
    bridge_table="college_university_degree_department_new", bridge_entity="college_id", bridge_keys=("id",),
    account_table="college_account_new", account_id="id",
    account_keys=("college_university_degree_department_id",), account_dummy="dummy",
)

# Fact tables with their account column and time column.
SOURCES = (
    Source("class_hours", "faculty_class_hours", "faculty_id", "entry_date"),
    Source("hook_search", "co_pilot_hook_search", "", "date_of_search",
           header=Header("college_account_co_pilot_search", "id", "college_account_id",
                         "college_account_co_pilot_search_id")),
    Source("lesson_plans", "co_pilot_lesson_plans", "college_account_id", "created_at"),
    Source("live_questionnaires", "questionnaire_live", "college_account_id", "start_time"),
    Source("live_surveys", "live_surveys", "college_account_id", "start_time"),
    Source("notifications", "notifications", "college_account_id", "created_at"),
    Source("video_conference", "video_conference", "college_account_id", "start_time"),
    Source("case_studies", "case_study_assignments", "college_account_id", "start_date"),
    Source("projects", "academic_projects", "college_account_id", "start_time"),
    Source("weekly_challenge", "weekly_challenge", "college_account_id", "start_date"),
    Source("coding_submissions", "college_account_coding_track_question_submissions", "college_account_id",
           "created_at"),
    Source("questionnaire", "questionnaire", "college_account_id", "start_time"),
    Source("subjective", "questionnaire_subjective", "college_account_id", "start_time"),
    Source("coding_test", "coding_test", "college_account_id", "start_time"),
    Source("survey", "survey", "faculty_id", "created_at"),
    Source("semester_feedback", "semester_feedback", "faculty_id", "created_at"),
    Source("faculty_feedback", "faculty_feedback", "college_account_id", "created_at"),
)

# Columns that the report reads of each table; types are those of the export (the original declares none).
_COUNTED = {"coding_submissions": ("question_id",), "subjective": ("id", "is_assignment"),
            "questionnaire": ("id", "remedial_path")}
COLUMNS = {
    "college": ("id", "college_name"),
    "college_university_degree_department_new": ("id", "college_id"),
    "college_account_new": ("id", "college_university_degree_department_id", "dummy"),
    "college_account_co_pilot_search": ("id", "college_account_id"),
    "questionnaire_remedial_path": ("id", "questionnaire_id"),
    **{s.table: (*_COUNTED.get(s.name, ("id",)), s.header.link if s.header else s.account, s.time) for s in SOURCES},
}

KINDS = {s.table: {s.time: "time"} for s in SOURCES}

# Tables without a window and their numeric keys, for parallel reads over JDBC.
JDBC_KEYS = {"college_account_new": "id", "college_university_degree_department_new": "id",
             "college_account_co_pilot_search": "id", "questionnaire_remedial_path": "id"}

# Metric key → (source, counted column, extra predicate, account flag placement).
_DISTINCT = {
    "metric_attendance": ("class_hours", "id", None, "on"),
    "metric_hook_search": ("hook_search", "id", None, "where"),
    "metric_teach_studio": ("lesson_plans", "id", None, "where"),
    "metric_live_assignment": ("live_questionnaires", "id", None, "on"),
    "metric_live_survey": ("live_surveys", "id", None, "on"),
    "metric_notifications": ("notifications", "id", None, "on"),
    "metric_live_class": ("video_conference", "id", None, "on"),
    "metric_case_study": ("case_studies", "id", None, "on"),
    "metric_projects": ("projects", "id", None, "on"),
    "metric_arena": ("weekly_challenge", "id", None, "on"),
    "metric_gocode": ("coding_submissions", "question_id", None, "on"),
    "metric_objective": ("questionnaire", "id", None, "on"),
    "metric_subjective": ("subjective", "id", "is_assignment = 0", "on"),
    "metric_coding": ("coding_test", "id", None, "on"),
    "metric_assignment": ("subjective", "id", "is_assignment = 1", "on"),
    "metric_regular_feedback": ("survey", "id", None, "on"),
    "metric_semester_feedback": ("semester_feedback", "id", None, "on"),
    "metric_unit_feedback": ("faculty_feedback", "id", None, "on"),
}


def metrics() -> tuple[Metric, ...]:
    out = []
    for key, module, column in ((k, MODULE_OF[k], COLUMN_OF[k]) for k in MODULE_OF):
        if key in _DISTINCT:
            source, value, where, placement = _DISTINCT[key]
            out.append(Metric(key, module, column, source, value=value, where=where, account_filter=placement))
        elif key == "metric_analyse":
            out.append(Metric(key, module, column, measure=CONSTANT, constant=0))
        elif key == "metric_remediate":
            out.append(Metric(key, module, column, "questionnaire", measure=PAIRS, value="id",
                              where="remedial_path = 1",
                              child=Child("questionnaire_remedial_path", "questionnaire_id", "id")))
    return tuple(out)


def report_spec(window: ReportWindow, allow: tuple[int, ...] | None = ALLOW_LIST,
                date_partition: str | None = None, key_filter_above: int = 64 << 20,
                key_filter_bits: int = 1 << 23) -> ReportSpec:
    """``date_partition`` names the DATE partition column of day-partitioned fact exports."""
    sources = tuple(replace(s, date_partition=date_partition) for s in SOURCES)
    return ReportSpec(spine=SPINE, sources=sources, metrics=metrics(), modules=MODULES, window=window,
                      allow=allow, key_filter_above=key_filter_above, key_filter_bits=key_filter_bits)


def entities_current_year(catalog: Catalog) -> DataFrame:
    """Entities with a department mapped to the current academic year (a query the original keeps dormant).

    Inner chain academic year → batch mapping → regulation mapping → department → college,
    ``DISTINCT (college_id, college_name, year name)``.
    """
    ay = catalog.table("academic_years").where(F.col("current_academic_year") == 1).select(
        F.col("id").alias("ay_id"), F.col("name"))
    cay = catalog.table("college_academic_years").select(
        F.col("academic_year_id").alias("ay_id"), F.col("regulation_batch_mapping_id").alias("rbm_id"))
    rbm = catalog.table("regulation_batch_mapping").select(
        F.col("id").alias("rbm_id"), F.col("regulation_mapping_id").alias("rm_id"))
    rm = catalog.table("regulation_mappings").select(F.col("id").alias("rm_id"), F.col("cudd_id"))
    cudd = catalog.table("college_university_degree_department_new").select(
        F.col("id").alias("cudd_id"), F.col("college_id"))
    college = catalog.table("college").select(F.col("id").alias("college_id"), "college_name")
    chain = (cay.join(ay, "ay_id").join(rbm, "rbm_id").join(rm, "rm_id").join(cudd, "cudd_id")
             .join(college, "college_id"))
    return chain.select("college_id", "college_name", "name").distinct()
