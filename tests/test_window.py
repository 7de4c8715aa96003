from __future__ import annotations

from datetime import date, datetime, timedelta

from daytally import ReportWindow
from daytally.functions.window import label


def test_bounds_and_labels():
    w = ReportWindow.closing_on(date(2024, 1, 5))
    assert w.start == datetime(2024, 1, 4, 8) and w.end == datetime(2024, 1, 5, 8)
    assert w.labels() == ("04-Jan-2024 (08:00 AM)", "05-Jan-2024 (08:00 AM)")
    assert w.generated_on() == "05-Jan-2024"


def test_for_run_resolves_once_from_the_given_clock():
    w = ReportWindow.for_run(datetime(2024, 3, 1, 23, 59), lookback=timedelta(days=7))
    assert w.end == datetime(2024, 3, 1, 8) and w.start == datetime(2024, 2, 23, 8)


def test_closed_bounds_on_spark_types(spark):
    w = ReportWindow.closing_on(date(2024, 1, 2))
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 8), date(2024, 1, 2)), (datetime(2024, 1, 2, 8), date(2024, 1, 1)),
         (datetime(2024, 1, 1, 7, 59, 59), date(2024, 1, 2)), (None, None)],
        "t TIMESTAMP_NTZ, d DATE")
    got = df.select(w.contains("t").alias("t_in"), w.contains("d").alias("d_in")).collect()
    assert [(r.t_in, r.d_in) for r in got] == [(True, True), (True, False), (False, True), (None, None)]
    lo, hi = w.bounds()
    row = spark.range(1).select(label(lo).alias("a"), label(hi).alias("b")).first()
    assert (row.a, row.b) == w.labels()
    assert dict(df.select(w.contains("t").alias("x")).dtypes)["x"] == "boolean"


def test_run_offsets_on_the_bounds(spark):
    """Run k holds [end - k days - lookback, end - k days]; a value on a cut is in two runs."""
    w = ReportWindow.closing_on(date(2024, 1, 16))
    values = [datetime(2024, 1, 16, 8), datetime(2024, 1, 15, 8), datetime(2024, 1, 15, 8, 0, 0, 1),
              datetime(2024, 1, 15, 7, 59, 59, 999999), datetime(2024, 1, 14, 12), datetime(2024, 1, 16, 8, 0, 0, 1),
              datetime(2024, 1, 9, 8), datetime(2024, 1, 8, 8)]
    df = spark.createDataFrame([(v,) for v in values], "t TIMESTAMP_NTZ")
    got = [r.k for r in df.selectExpr(f"{w.run_offsets_sql('t', 7)} AS k").collect()]
    # Run 6 is [01-09 08:00, 01-10 08:00]; its lower bound would also open run 7, outside the range.
    assert got == [[0], [0, 1], [0], [1], [1], [], [6], []]


def test_catalog_sql_runs_over_catalog_tables(spark):
    from daytally import Catalog

    cat = Catalog.parquet_dir(spark, "/root/testdata/sf0.001")
    assert cat.sql("SELECT count(*) AS n FROM nation", ["nation"]).first().n == 25
