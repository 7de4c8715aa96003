"""Physical plan checks: the properties the design relies on at scale."""

from __future__ import annotations

import re

from daytally.plans.queries import fixture_report, queries

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_and_no_python_in_any_query(spark):
    for key, fn in queries().items():
        plan = _plan(fn(spark, SF001))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in plan, (key, bad)


def test_one_scan_of_the_event_source(spark):
    plan = _plan(fixture_report(spark, SF001).detail())
    scans = re.findall(r"FileScan parquet [^\n]*events\.parquet", plan)
    assert len(scans) == 1


def test_window_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(fixture_report(spark, SF001).metric("metric_attendance"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "GreaterThanOrEqual(ts,2024-01-15T08:00)" in scan
    assert "LessThanOrEqual(ts,2024-01-16T08:00)" in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in scan


def test_distinct_counts_do_not_expand(spark):
    plan = _plan(fixture_report(spark, SF001).detail())
    assert "Expand" not in plan


def test_single_partition_only_after_aggregation(spark):
    rep = fixture_report(spark, SF001)
    plan = rep.summary()._jdf.queryExecution().executedPlan()
    text = plan.toString()
    # The only SinglePartition exchange sorts the per-entity rows for the serial number.
    assert text.count("Exchange SinglePartition") <= 1


def _jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_account_map_needs_no_job_and_is_broadcast_by_its_size(spark):
    fixture_report(spark, SF001).metric("metric_attendance")  # file schemas are read once per application
    before = _jobs(spark)
    plan = _plan(fixture_report(spark, SF001).metric("metric_attendance"))
    assert _jobs(spark) == before  # building the query runs nothing
    assert "BroadcastHashJoin [link" in plan
    assert "hashpartitioning(account_id" not in plan


def test_entities_with_an_account_are_reduced_before_the_semi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _plan(replace_bound(fixture_report(spark, SF001), 0).metric("metric_teach_studio"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    semi = plan[plan.index("LeftSemi"):]
    # What is shuffled for the semi join comes out of a partial aggregate, not straight from the accounts.
    assert re.search(r"HashAggregate\(keys=\[entity_id[^\n]*\n[^\n]*Exchange hashpartitioning\(entity_id[^\n]*\n"
                     r"[^\n]*HashAggregate\(keys=\[entity_id", semi)


def test_parents_reach_their_entity_before_the_child(spark):
    """With and without the reduction and automatic broadcasts: no row per pair is shuffled by account."""
    want = sorted(fixture_report(spark, SF001).metric("metric_remediate").collect())
    for bound, threshold in ((64 << 20, "-1"), (0, "-1"), (0, "10MB")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        before = _jobs(spark)
        df = replace_bound(fixture_report(spark, SF001), bound).metric("metric_remediate")
        plan = _plan(df)
        assert _jobs(spark) == before  # building the query runs nothing
        got = sorted(df.collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == want
        lines = plan.splitlines()
        child = next(i for i, x in enumerate(lines) if "lineitem.parquet" in x)
        # What leaves the child's scan is a partial count per parent, reduced by the parents' bits where asked for.
        above = next(x for x in reversed(lines[:child]) if _moves_rows(x))
        assert "hashpartitioning(c_link" in above
        assert any("partial_count" in x and "c_link" in x for x in lines[lines.index(above):child])
        assert any("Filter" in x and "Subquery" in x and "xxhash64" in x for x in lines[lines.index(above):child]) == (bound == 0)


def _moves_rows(line: str) -> bool:
    """An exchange, but not one of the bitmap's subquery."""
    return "Exchange" in line and "word#" not in line and "SinglePartition" not in line


def replace_bound(report, above: int):
    from dataclasses import replace

    from daytally import DailyReport

    return DailyReport(report.catalog, replace(report.spec, key_filter_above=above))


def test_date_partitioned_source_prunes_days(spark, scratch_dir):
    from dataclasses import replace

    from daytally import Catalog, DailyReport
    from daytally.plans import fixture

    events = spark.read.parquet(f"{SF001}/events.parquet")
    path = f"{scratch_dir}/events_by_day"
    events.withColumn("event_date", events.ts.cast("date")).write.partitionBy("event_date").parquet(path)
    spec = fixture.report_spec()
    sources = tuple(replace(s, table="events_by_day", date_partition="event_date") if s.name == "events" else s
                    for s in spec.sources)
    catalog = Catalog.parquet_dir(spark, SF001, paths={"events_by_day": path})
    rep = DailyReport(catalog, replace(spec, sources=sources))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(rep.metric("metric_attendance"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "events_by_day" in line)
    assert "PartitionFilters: [isnotnull(event_date" in scan and "2024-01-15" in scan and "2024-01-16" in scan
    base = fixture_report(spark, SF001)
    assert sorted(rep.metric("metric_attendance").collect()) == sorted(base.metric("metric_attendance").collect())


def test_header_meets_the_leaf_before_any_account(spark):
    """The header is reduced to the leaf's links and moves on its id only, never on the account."""
    want = sorted(fixture_report(spark, SF001).metric("metric_hook_search").collect())
    for bound, threshold in ((0, "-1"), (64 << 20, "-1"), (0, "10MB")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        before = _jobs(spark)
        df = replace_bound(fixture_report(spark, SF001), bound).metric("metric_hook_search")
        plan = _plan(df)
        assert _jobs(spark) == before
        got = sorted(df.collect())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == want
        lines = plan.splitlines()
        header = next(i for i, x in enumerate(lines) if "orders.parquet" in x)
        if threshold == "-1":
            above = next(x for x in reversed(lines[:header]) if _moves_rows(x))
            assert "hashpartitioning(h_id" in above
        join = next(i for i in range(header, 0, -1) if "Join" in lines[i])
        assert "h_id" in lines[join] and "account_id" not in lines[join]
        assert any("Subquery" in x and "xxhash64" in x for x in lines[join:header]) == (bound == 0)
        # The account map joins above, once for all rows that have an account by then.
        assert sum("Join [link" in x and "account_id" in x for x in lines) == 1


def test_one_account_join_for_all_sources(spark):
    plan = _plan(fixture_report(spark, SF001).detail())
    assert sum("Join [link" in x and "account_id" in x for x in plan.splitlines()) == 1
