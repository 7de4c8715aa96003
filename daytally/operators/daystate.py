"""Exact day states: a day is measured once, and any window of days is merged from its states.

A daily window is closed at both ends, so the windows of consecutive days cover the window of all of them.
The state of a day keeps, per entity and metric,

* for integral keys, bitmaps of the distinct keys in buckets of Spark's bitmap functions; days are merged with
  ``bitmap_or_agg`` and counted with ``bitmap_count``, so a key of several days counts once;
* for other keys, the distinct keys themselves;
* for pair metrics, the pairs of the day, and of those whose parent lies after the day's first instant, so
  that a parent on the cut between two days counts once.

All are aggregated on the map side: what is shuffled for a day is at most a bitmap per entity, metric,
bucket and task, and a merge reads states only, never facts.  Accounts belong to the entity that
they had when the day was measured.  Sources whose window is longer than a day are kept in days too.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.window import ReportWindow
from .measure import LATER, RANGE, RUN, Measure, _bit
from .report import DailyReport
from .specs import DISTINCT, PAIRS, Metric, ReportSpec

DAY = timedelta(days=1)
SCHEMA = ("source STRING, day DATE, metric STRING, entity_id {id}, bucket BIGINT, bits BINARY, text_key STRING, "
          "n BIGINT, n_later BIGINT")


def days_of(window: ReportWindow, runs: int = 1) -> list[date]:
    """The days (of their closing cut) that the window and the ``runs - 1`` before it are made of."""
    if window.lookback % DAY:
        raise ValueError("a window of day states must span whole days")
    return [window.report_date - timedelta(days=k) for k in range(window.lookback.days + runs - 1)]


def _daily(spec: ReportSpec, source_name: str, last: date) -> ReportSpec:
    """The spec with one source's window set to the single day that closes on ``last``."""
    cut = spec.window_of(spec.source_by_name[source_name]).end.time()
    window = ReportWindow.closing_on(last, lookback=DAY)
    window = replace(window, end=window.end.replace(hour=cut.hour, minute=cut.minute, second=cut.second))
    return replace(spec, sources=tuple(replace(s, window=window) if s.name == source_name else s for s in spec.sources))


def measure_days(report: DailyReport, source_name: str, last: date, days: int) -> DataFrame:
    """States of the ``days`` days up to ``last`` of a source, from one scan of it."""
    spec = _daily(report.spec, source_name, last)
    measure = Measure(report.catalog, spec)
    runs = max(days, 2)  # the rows carry their runs
    numbered = [(i, m) for i, m in enumerate(m for m in spec.metrics if m.source == source_name)]
    name = F.element_at(F.array(*(F.lit(m.key) for _, m in numbered)), F.col("mid") + 1).alias("metric")
    day = F.date_sub(F.lit(last), F.col(RUN)).alias("day")
    parts = []
    rows = measure.keyed_rows(numbered, runs)
    if rows is not None:
        mids = [F.when(F.expr(f"(mask & {_bit(i)}) <> 0"), F.lit(i)) for i, m in numbered if m.measure == DISTINCT]
        each = (rows.withColumn(RUN, F.explode(F.sequence(*RANGE))).where(F.col(RUN) < days)
                .withColumn("mid", F.explode(F.array_compact(F.array(*mids)))))
        whole = (each.where("k_num IS NOT NULL")
                 .groupBy(RUN, "mid", "entity_id", F.expr("bitmap_bucket_number(k_num)").alias("bucket"))
                 .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(k_num))").alias("bits")))
        parts.append(whole.select(day, name, "entity_id", "bucket", "bits"))
        text = each.where("k_str IS NOT NULL").select(RUN, "mid", "entity_id", F.col("k_str").alias("text_key")).distinct()
        parts.append(text.select(day, name, "entity_id", "text_key"))
    for i, m in numbered:
        if m.measure == PAIRS:
            pairs = (measure._pair_rows(i, m, runs, later=True).where(F.col(RUN) < days).groupBy(RUN, "entity_id")
                     .agg(F.sum("n").alias("n"), F.sum(F.when(F.col(LATER), F.col("n")).otherwise(0)).alias("n_later")))
            parts.append(pairs.select(day, F.lit(m.key).alias("metric"), "entity_id", "n", "n_later"))
    if not parts:
        raise ValueError(f"no metric reads {source_name}")
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _shaped(found.withColumn("source", F.lit(source_name)), report)


def _shaped(df: DataFrame, report: DailyReport) -> DataFrame:
    """All state columns, in order."""
    kind = report.measure().entities.schema["entity_id"].dataType.simpleString()
    missing = {c.split()[0]: c.split()[1] for c in SCHEMA.format(id=kind).split(", ")}
    return df.select(*(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in missing.items()))


def states(report: DailyReport, runs: int = 1) -> DataFrame:
    """States of every day that the report and the ``runs - 1`` before it need."""
    parts = []
    for source in _sources(report.spec):
        days = days_of(report.spec.window_of(report.spec.source_by_name[source]), runs)
        parts.append(measure_days(report, source, days[0], len(days)))
    return reduce(DataFrame.unionByName, parts)


def _sources(spec: ReportSpec) -> list[str]:
    return list(dict.fromkeys(m.source for m in spec.metrics if m.measure in (DISTINCT, PAIRS)))


def write_states(report: DailyReport, path: str, runs: int = 1) -> dict[str, list[date]]:
    """Measure the days that ``path`` lacks and add them, by source and day; returns the days measured.

    The missing days of a source are scanned in one go, from the first to the last of them.
    """
    spark, added = report.catalog.spark, {}
    known = stored_days(report, path)
    for source in _sources(report.spec):
        missing = sorted(set(days_of(report.spec.window_of(report.spec.source_by_name[source]), runs)) - known.get(source, set()))
        if not missing:
            continue
        found = measure_days(report, source, missing[-1], (missing[-1] - missing[0]).days + 1).where(F.col("day").isin(missing))
        # A row for each measured day, so that a day without activity is known too.
        seen = _shaped(spark.createDataFrame([(source, d) for d in missing], "source STRING, day DATE"), report)
        (found.unionByName(seen).repartition("source", "day").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("source", "day").parquet(path))
        added[source] = missing
    return added


def read_states(report: DailyReport, path: str) -> DataFrame:
    kind = report.measure().entities.schema["entity_id"].dataType.simpleString()
    return report.catalog.spark.read.schema(SCHEMA.format(id=kind)).parquet(path)


def stored_days(report: DailyReport, path: str) -> dict[str, set[date]]:
    """The days that are kept, by source (folder names only)."""
    spark = report.catalog.spark
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[str, set[date]] = {}
    for status in (fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(target, "source=*/day=*")) or []):
        day, source = status.getPath().getName(), status.getPath().getParent().getName()
        out.setdefault(source.split("=", 1)[1], set()).add(date.fromisoformat(day.split("=", 1)[1]))
    return out


def merged_wide(report: DailyReport, state: DataFrame, runs: int = 1, metrics: Iterable[Metric] | None = None) -> DataFrame:
    """What ``DailyReport.wide`` measures, from day states: one row per entity (and run), a column per metric."""
    spec = report.spec
    metrics = [m for m in (spec.metrics if metrics is None else metrics) if m.measure in (DISTINCT, PAIRS)]
    base = report.measure().entities
    back = base.selectExpr("*", f"explode(sequence(0, {runs - 1})) AS {RUN}")
    if not metrics:
        return back if runs > 1 else base
    length = {m.source: len(days_of(spec.window_of(spec.source_by_name[m.source]))) for m in metrics}
    last = {s: spec.window_of(spec.source_by_name[s]).report_date for s in length}
    # A day d is in the windows of the runs k with last - k - length < d <= last - k.
    cases = []
    for s in length:
        ago = f"datediff(DATE '{last[s].isoformat()}', day)"
        low, high = f"greatest({ago} - {length[s] - 1}, 0)", f"least({ago}, {runs - 1})"
        cases.append(f"WHEN source = '{s}' AND {ago} >= 0 AND {low} <= {high} THEN sequence({low}, {high})")
    spread = (state.where(F.col("source").isin(list(length)) & F.col("metric").isin([m.key for m in metrics]))
              .selectExpr("*", f"explode(CASE {' '.join(cases)} END) AS {RUN}"))
    keys = [RUN, "metric", "entity_id"]
    whole = (spread.where("bits IS NOT NULL").groupBy(*keys, "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
             .select(*keys, F.expr("bitmap_count(bits)").alias("n")))
    text = spread.where("text_key IS NOT NULL").select(*keys, "text_key").distinct().select(*keys, F.lit(1).cast("bigint").alias("n"))
    first = F.expr("CASE " + " ".join(
        f"WHEN source = '{s}' THEN date_sub(DATE '{last[s].isoformat()}', {RUN} + {length[s] - 1})" for s in length) + " END")
    pairs = spread.where("n IS NOT NULL").select(*keys, F.when(F.col("day") == first, F.col("n")).otherwise(F.col("n_later")).alias("n"))
    long = whole.unionByName(text).unionByName(pairs)
    counts = long.groupBy(RUN, "entity_id").agg(
        *(F.sum(F.when(F.col("metric") == m.key, F.col("n"))).alias(m.column) for m in metrics))
    out = back.join(counts, [RUN, "entity_id"], "left").select("entity_id", "entity_name", RUN, *(m.column for m in metrics))
    return out if runs > 1 else out.drop(RUN)


def report_wide(report: DailyReport, state: DataFrame, runs: int = 1) -> DataFrame:
    """``merged_wide`` with constants and zeros filled in, as the report builders take it."""
    return report.filled(merged_wide(report, state, runs), list(report.spec.metrics), runs)
