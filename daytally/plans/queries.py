"""Registered queries over the fixture tables: one callable per key, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import daystate
from ..operators.report import DailyReport
from ..sources.catalog import Catalog
from . import fixture
from .fixture_oracle import BACKFILL_RUNS
from .layout import METRIC_LAYOUT, MODULES

Query = Callable[[SparkSession, str], DataFrame]


def fixture_report(spark: SparkSession, sf_dir: str) -> DailyReport:
    return DailyReport(fixture_catalog(spark, sf_dir), fixture.report_spec())


def fixture_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog.parquet_dir(spark, sf_dir, schemas=fixture.SCHEMAS)


def _metric(key: str) -> Query:
    return lambda spark, sf_dir: fixture_report(spark, sf_dir).metric(key)


def _module(module: str) -> Query:
    return lambda spark, sf_dir: fixture_report(spark, sf_dir).module(module)


def backfill_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill from day states: every day is measured once, every window is merged from its days."""
    report = fixture_report(spark, sf_dir)
    wide = daystate.report_wide(report, daystate.states(report, BACKFILL_RUNS), BACKFILL_RUNS)
    return report.backfill_detail(BACKFILL_RUNS, wide)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "spine_active_accounts": lambda spark, d: fixture_report(spark, d).spine_active_accounts(),
        "report_window": lambda spark, d: fixture_report(spark, d).window_audit(),
    }
    for key, _, _ in METRIC_LAYOUT:
        out[key] = _metric(key)
    for module in MODULES:
        out[f"module_{module}"] = _module(module)
    out["report_detail"] = lambda spark, d: fixture_report(spark, d).detail()
    out["report_summary_ranked"] = lambda spark, d: fixture_report(spark, d).summary_ranked()
    out["report_summary"] = lambda spark, d: fixture_report(spark, d).summary()
    out["report_backfill"] = lambda spark, d: fixture_report(spark, d).backfill_detail(BACKFILL_RUNS)
    out["report_backfill_summary"] = lambda spark, d: fixture_report(spark, d).backfill_summary(BACKFILL_RUNS)
    out["report_backfill_merged"] = backfill_merged
    out["entities_current_year"] = lambda spark, d: fixture.entities_current_year(fixture_catalog(spark, d))
    return out
