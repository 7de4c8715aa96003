"""Every registered query against its DuckDB oracle (original per-metric shape) at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from daytally import Catalog, DailyReport
from daytally.plans import fixture, fixture_oracle
from daytally.plans.queries import queries
from tools.check_oracle import TABLES, rows_of

from .conftest import SF001


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) <= set(entry.queries())
    assert set(queries()) == set(fixture_oracle.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, duck, key):
    got = entry.queries()[key](spark, SF001).toPandas()
    want = duck.execute(entry.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 and rows[-1]["s_no"] == "Total"
    assert df.columns == ["s_no", "college_id", "college_name", "teach", "engage", "assess", "track",
                          "analyse", "remediate", "total"]


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_doubled_fact_rows_match_the_oracle(spark, duck, bound):
    """Every event, order and line item present twice, as after a repeated load."""
    import dataclasses

    facts = ("events", "orders", "lineitem")
    cat = Catalog.parquet_dir(spark, SF001, schemas=fixture.SCHEMAS)
    con = duckdb.connect()
    for t in TABLES:
        twice = f" UNION ALL SELECT * FROM read_parquet('{SF001}/{t}.parquet')" if t in facts else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet'){twice}")
        if t in facts:
            cat._loaded[t] = cat.table(t).unionByName(cat.table(t))
    report = DailyReport(cat, dataclasses.replace(fixture.report_spec(), key_filter_above=bound))
    for key, df in (("report_detail", report.detail()), ("report_summary", report.summary()),
                    ("report_backfill", report.backfill_detail(fixture_oracle.BACKFILL_RUNS)),
                    ("metric_attendance", report.metric("metric_attendance"))):
        want = con.execute(fixture_oracle.oracle_sql()[key]).df()
        assert rows_of(df.toPandas()) == rows_of(want), key
