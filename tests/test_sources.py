"""Key ranges over JDBC (with a stubbed query) and column types of files."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from daytally import Catalog
from daytally.plans import job, reference_schema
from daytally.sources import JdbcConfig, Partitioning, catalog, jdbc_options, with_key_ranges
from daytally.sources.jdbc import key_bounds_sql, window_reads

KEYS = {"accounts": "id", "headers": "h_id", "children": "id", "bridge": "id"}


def test_one_statement_asks_for_all_bounds():
    assert key_bounds_sql({"b": "id", "a": "k"}) == (
        "SELECT 'a' AS table_name, MIN(k) AS low, MAX(k) AS high FROM a UNION ALL "
        "SELECT 'b' AS table_name, MIN(id) AS low, MAX(id) AS high FROM b")


def test_ranges_from_bounds_and_by_hand():
    asked = []

    def run(sql):
        asked.append(sql)
        return [("accounts", 1, 2_500_000), ("children", 10, 900_000_000_000), ("bridge", None, None)]

    by_hand = Partitioning("x", 0, 5, 3)
    cfg = JdbcConfig(url="jdbc:mysql://h/db", keys=KEYS, partitioning={"headers": by_hand}, max_ranges=64)
    got = with_key_ranges(cfg, run)
    assert len(asked) == 1 and "headers" not in asked[0]
    assert got.partitioning == {"accounts": Partitioning("id", 1, 2_500_001, 3),
                                "children": Partitioning("id", 10, 900_000_000_001, 64), "headers": by_hand}
    opts = jdbc_options(got, "children")
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == (
        "id", "10", "900000000001", "64")
    assert "partitionColumn" not in jdbc_options(got, "bridge")
    assert with_key_ranges(got, run) is got and len(asked) == 1  # nothing left to ask
    small = with_key_ranges(JdbcConfig(url="u", keys={"t": "id"}), lambda sql: [("t", -5, 5)])
    assert small.partitioning == {}


def test_catalog_asks_once_and_only_for_keyed_tables(spark, monkeypatch):
    asked, read = [], []

    def run(sql):
        asked.append(sql)
        return [("accounts", 0, 9_999_999), ("headers", 0, 3)]

    monkeypatch.setattr(catalog, "read_jdbc", lambda spark, cfg, table: read.append(jdbc_options(cfg, table)) or spark.range(1))
    cat = Catalog(spark, jdbc=JdbcConfig(url="jdbc:x:y", keys=KEYS), bounds=run)
    cat.table("facts")
    assert not asked
    for t in ("accounts", "headers", "accounts"):
        cat.table(t)
    assert len(asked) == 1 and [r.get("numPartitions") for r in read] == [None, "10", None]


def test_command_line_keeps_hand_given_ranges(spark, monkeypatch):
    for key in ("DB_HOST", "DB_NAME"):
        monkeypatch.setenv(key, "x")
    table = "college_account_co_pilot_search"
    report = job.build_report(spark, job._arguments(
        ["--out", "o", "--report-date", "2024-01-02", "--jdbc-key-range", f"{table}:id:0:9:3", "--jdbc-rows-per-range", "10"]))
    cfg = with_key_ranges(report.catalog.jdbc, lambda sql: [(t, 0, 99) for t in reference_schema.JDBC_KEYS if f"'{t}'" in sql])
    assert cfg.partitioning[table] == Partitioning("id", 0, 9, 3)
    assert cfg.partitioning["college_account_new"] == Partitioning("id", 0, 100, 10)


def written(spark, folder, **columns):
    spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items())).write.mode("overwrite").parquet(f"{folder}/t.parquet")


@pytest.mark.parametrize("value,fits", [
    ("TIMESTAMP_NTZ '2024-01-01 00:00:00'", True), ("DATE '2024-01-01'", True), ("'2024-01-01 00:00:00'", False), ("1704067200", False)])
def test_time_columns_by_kind(spark, scratch_dir, value, fits):
    written(spark, scratch_dir, id="1L", at=value)
    cat = Catalog.parquet_dir(spark, scratch_dir, columns={"t": ("id", "at")}, kinds={"t": {"at": "time"}})
    if fits:
        assert cat.table("t").count() == 1
    else:
        with pytest.raises(ValueError, match="at is"):
            cat.table("t")


@pytest.mark.parametrize("value,declared,fits", [
    ("TIMESTAMP_NTZ '2024-01-01 00:00:00'", "TIMESTAMP_NTZ", True), ("DATE '2024-01-01'", "TIMESTAMP_NTZ", True),
    ("TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP_NTZ", False), ("'2024-01-01'", "TIMESTAMP_NTZ", False),
    ("CAST(7 AS INT)", "BIGINT", True), ("7L", "INT", False), ("'7'", "BIGINT", False), ("CAST(1 AS FLOAT)", "DOUBLE", True)])
def test_declared_types(spark, scratch_dir, value, declared, fits):
    written(spark, scratch_dir, x=value)
    cat = Catalog.parquet_dir(spark, scratch_dir, schemas={"t": f"x {declared}"})
    if fits:
        (row,) = cat.table("t").collect()
        assert row.x is not None and cat.table("t").schema["x"].dataType.simpleString() == declared.lower()
    else:
        with pytest.raises(ValueError, match="declared"):
            cat.table("t")


def test_every_windowed_source_declares_its_time():
    assert all(reference_schema.KINDS[s.table] == {s.time: "time"} for s in reference_schema.SOURCES)


def _rendered(spark, instants, reads):
    """What a database would send: each read's rows in the wall-clock time of its session's offset, its predicates applied."""
    got = []
    for opts, preds in reads:
        sign, hours, minutes = re.search(r"'([+-])(\d\d):(\d\d)'", opts["sessionInitStatement"]).groups()
        shift = timedelta(hours=int(hours), minutes=int(minutes)) * (-1 if sign == "-" else 1)
        rows = spark.createDataFrame([(i, t + shift) for i, t in enumerate(instants)], "id int, t timestamp_ntz")
        for p in preds:
            got += [(r.id, r.t) for r in rows.where(p).collect()]
    return sorted(got)


@pytest.mark.parametrize("zone,day", [("America/New_York", datetime(2024, 11, 4, 8)), ("America/New_York", datetime(2024, 3, 11, 8)),
                                      ("Australia/Lord_Howe", datetime(2024, 4, 8, 8)), ("Asia/Kolkata", datetime(2024, 4, 8, 8))])
def test_instants_are_read_in_their_own_offset(spark, zone, day):
    """Over a clock change every instant arrives once, in its own wall-clock time, and a week's read is its days' reads."""
    tz = ZoneInfo(zone)
    start = day - timedelta(days=3)
    first = start.replace(tzinfo=tz).astimezone(timezone.utc).replace(tzinfo=None)
    instants = [first + timedelta(minutes=10 * k) for k in range(-30, 6 * 24 * 3 + 30)] + [first + timedelta(hours=42, microseconds=1)]
    wall = [t.replace(tzinfo=timezone.utc).astimezone(tz).replace(tzinfo=None) for t in instants]
    cfg = JdbcConfig("jdbc:mysql://h/d", time_slices=4, zone=zone, instants=frozenset({"facts"}))
    reads = window_reads(cfg, "facts", "t", start, day)
    assert _rendered(spark, instants, reads) == sorted((i, t) for i, t in enumerate(wall) if start <= t <= day)
    days = set()
    for k in range(3):
        low, high = day - timedelta(days=k + 1), day - timedelta(days=k)
        days |= set(_rendered(spark, instants, window_reads(cfg, "facts", "t", low, high)))
    assert days == set(_rendered(spark, instants, reads))
    assert len(reads) == (1 if zone == "Asia/Kolkata" else 2)


def test_wall_clock_columns_take_one_read():
    cfg = JdbcConfig("jdbc:mysql://h/d", time_slices=4, zone="America/New_York", zone_offset="-05:00", instants=frozenset({"facts"}))
    reads = window_reads(cfg, "other", "t", datetime(2024, 11, 1, 8), datetime(2024, 11, 4, 8))
    assert len(reads) == 1 and len(reads[0][1]) == 4 and "-05:00" in reads[0][0]["sessionInitStatement"]
