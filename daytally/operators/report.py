"""Report frames built from one measurement plan.

Every output has one row per allow-listed entity (see :class:`~.measure.Measure`), with the
report's fill rule: a missing count is 0, a missing entity name is ``'0'``.  The entity
dimension therefore bounds every output, so ordering and serial numbers after the
aggregation move only that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, row_sum, zero, zero_filled
from ..functions.window import day_label, label
from ..sources.catalog import Catalog
from .measure import RUN, Measure, scan_window
from .spine import build_spine
from .specs import CONSTANT, Metric, ReportSpec

# Fixed values of the original summary's total row.
TOTAL_SNO = "Total"
TOTAL_ID = "-"
TOTAL_NAME = "Overall Total"
MISSING_NAME = "0"


class DailyReport:
    def __init__(self, catalog: Catalog, spec: ReportSpec):
        self.catalog = catalog
        self.spec = spec
        self._spine: DataFrame | None = None
        self._measure: Measure | None = None

    # -- building blocks -----------------------------------------------------------------

    def spine(self) -> DataFrame:
        if self._spine is None:
            m = self.measure()
            self._spine = build_spine(self.catalog, self.spec.spine, m.departments, m.entities)
        return self._spine

    def measure(self) -> Measure:
        if self._measure is None:
            self._measure = Measure(self.catalog, self.spec)
        return self._measure

    def wide(self, metrics: list[Metric] | None = None, runs: int = 1) -> DataFrame:
        """entity_id, entity_name and one zero-filled bigint column per metric (plus ``_run``
        when several daily runs are measured together)."""
        metrics = list(self.spec.metrics if metrics is None else metrics)
        return self.filled(self.measure().wide(metrics, runs), metrics, runs)

    def filled(self, out: DataFrame, metrics: list[Metric], runs: int = 1) -> DataFrame:
        """A measured frame with its constants added and its missing counts 0."""
        cols = [f"CAST({m.constant} AS BIGINT) AS {q(m.column)}" if m.measure == CONSTANT
                else f"{zero(m.column)} AS {q(m.column)}" for m in metrics]
        return out.selectExpr("entity_id", "entity_name", *([RUN] if runs > 1 else []), *cols)

    def _named(self, df: DataFrame, fill_name: bool) -> DataFrame:
        name = F.col("entity_name")
        if fill_name:
            name = F.coalesce(name, F.lit(MISSING_NAME))
        rest = [c for c in df.columns if c not in ("entity_id", "entity_name")]
        return df.select(F.col("entity_id").alias(self.spec.id_col), name.alias(self.spec.name_col), *rest)

    # -- queries ---------------------------------------------------------------------------

    def spine_active_accounts(self) -> DataFrame:
        return self._named(self.spine(), fill_name=False)

    def metric(self, key: str) -> DataFrame:
        """One metric exactly as its own statement returns it (no name fill).

        With the account flag in WHERE, an entity without any real account has no row.
        """
        m = self.spec.metric(key)
        df = self.wide([m])
        if m.account_filter == "where":
            # Distinct first: a few ids per task leave the account map, however large one entity is.
            has_account = self.measure().account_map.select("entity_id").distinct()
            df = df.join(has_account, "entity_id", "left_semi")
        return self._named(df, fill_name=False)

    def module(self, module: str) -> DataFrame:
        return self._named(self.wide(self.spec.module_metrics(module)), fill_name=True)

    def detail(self, wide: DataFrame | None = None) -> DataFrame:
        wide = self.wide() if wide is None else wide
        cols = [m.column for m in self.spec.metrics]
        df = wide.selectExpr("CAST(row_number() OVER (ORDER BY entity_id) AS BIGINT) AS s_no", "entity_id",
                             "entity_name", *zero_filled(cols), f"{row_sum(cols)} AS {q(self.spec.usage_col)}")
        df = self._named(df, fill_name=True)
        return df.select("s_no", self.spec.id_col, self.spec.name_col, *cols, self.spec.usage_col)

    def backfill_detail(self, runs: int, wide: DataFrame | None = None) -> DataFrame:
        """The detail table of ``runs`` consecutive daily reports (the latest is the report's own
        day), measured in one pass: each fact row is scanned once and counted in every run
        whose closed window holds it.  Each day equals the daily job run for that day.
        ``report_date`` is the ISO day text (the same in every engine's client)."""
        wide = self._runs_wide(runs, wide)
        cols = [m.column for m in self.spec.metrics]
        df = wide.selectExpr(
            f"{self._report_date_sql()} AS report_date",
            f"CAST(row_number() OVER (PARTITION BY {RUN} ORDER BY entity_id) AS BIGINT) AS s_no",
            "entity_id", "entity_name", *zero_filled(cols), f"{row_sum(cols)} AS {q(self.spec.usage_col)}")
        df = self._named(df, fill_name=True)
        return df.select("report_date", "s_no", self.spec.id_col, self.spec.name_col, *cols, self.spec.usage_col)

    def _runs_wide(self, runs: int, wide: DataFrame | None) -> DataFrame:
        if runs < 1:
            raise ValueError("runs must be >= 1")
        wide = self.wide(runs=runs) if wide is None else wide
        return wide if RUN in wide.columns else wide.selectExpr("*", f"0 AS {RUN}")

    def _report_date_sql(self) -> str:
        """ISO text (yyyy-MM-dd) of the run's report day: the report day moved ``_run`` days back."""
        return f"CAST(date_sub(DATE '{self.spec.window.report_date.isoformat()}', {RUN}) AS STRING)"

    def backfill_summary(self, runs: int, wide: DataFrame | None = None) -> DataFrame:
        """The summary (ranked rows and a total row) of each of ``runs`` daily reports, in one pass."""
        wide = self._runs_wide(runs, wide)
        return self._summary(self._module_totals(wide), runs=runs)

    def _module_totals(self, wide: DataFrame) -> DataFrame:
        totals = [f"{row_sum([m.column for m in self.spec.module_metrics(mod)])} AS {q(mod)}"
                  for mod in self.spec.modules]
        df = wide.selectExpr("entity_id", "entity_name", *([RUN] if RUN in wide.columns else []), *totals)
        return df.selectExpr("*", f"{row_sum(list(self.spec.modules))} AS total")

    def summary_ranked(self, wide: DataFrame | None = None) -> DataFrame:
        wide = self.wide() if wide is None else wide
        df = self._module_totals(wide)
        df = df.selectExpr("entity_id", "entity_name",
                           "CAST(row_number() OVER (ORDER BY total DESC, entity_id ASC) AS BIGINT) AS s_no",
                           *[q(m) for m in self.spec.modules], "total")
        df = self._named(df, fill_name=True)
        return df.select("s_no", self.spec.id_col, self.spec.name_col, *self.spec.modules, "total")

    def summary(self, wide: DataFrame | None = None) -> DataFrame:
        """Ranked rows plus the grand-total row, in the ranking's own window stage.

        One zero-valued seed row joins the per-entity rows; it sorts after every entity, so
        the serial numbers are unchanged, and it becomes the total row from ``sum(..) OVER ()``
        computed in the same single-partition window (no union with a second aggregate,
        which would evaluate the measurement twice).  With no entities the seed alone gives
        a total row of zeros, as the original's column sums over an empty frame do.
        """
        wide = self.wide() if wide is None else wide
        return self._summary(self._module_totals(wide), runs=None)

    def _summary(self, totals: DataFrame, runs: int | None) -> DataFrame:
        """Ranked rows + total row; per run (window partitioned by run) when ``runs`` is given."""
        value_cols = list(self.spec.modules) + ["total"]
        id_type = totals.schema["entity_id"].dataType.simpleString()
        run_seed = [f"explode(sequence(0, {runs - 1})) AS {RUN}"] if runs else []
        seed = totals.sparkSession.range(1).selectExpr(
            f"CAST(NULL AS {id_type}) AS entity_id", "CAST(NULL AS STRING) AS entity_name", *run_seed,
            *[f"CAST(0 AS BIGINT) AS {q(c)}" for c in value_cols], "true AS _seed")
        rows = totals.selectExpr("*", "false AS _seed").unionByName(seed)
        part = f"PARTITION BY {RUN} " if runs else ""
        ranked = rows.selectExpr(
            "*", f"CAST(row_number() OVER ({part}ORDER BY _seed, total DESC, entity_id ASC) AS BIGINT) AS _rank",
            *[f"sum({q(c)}) OVER ({part.strip()}) AS {q('_sum_' + c)}" for c in value_cols])
        idc, namec = q(self.spec.id_col), q(self.spec.name_col)
        out = ranked.selectExpr(
            *([f"{self._report_date_sql()} AS report_date", RUN] if runs else []),
            f"CASE WHEN _seed THEN '{TOTAL_SNO}' ELSE CAST(_rank AS STRING) END AS s_no",
            f"CASE WHEN _seed THEN '{TOTAL_ID}' ELSE CAST(entity_id AS STRING) END AS {idc}",
            f"CASE WHEN _seed THEN '{TOTAL_NAME}' ELSE coalesce(entity_name, '{MISSING_NAME}') END AS {namec}",
            *[f"CASE WHEN _seed THEN CAST({q('_sum_' + c)} AS BIGINT) ELSE {q(c)} END AS {q(c)}" for c in value_cols],
            "_rank")
        if runs:
            # Each run's rows sit in the window's partition for that run: order them locally.
            return out.sortWithinPartitions(RUN, "_rank").drop(RUN, "_rank")
        # Already one partition (the window's); order it locally, no range shuffle.
        return out.sortWithinPartitions("_rank").drop("_rank")

    def window_audit(self) -> DataFrame:
        """Per source: the closed window, its labels and the number of source rows inside it."""
        parts = []
        for source in self.spec.sources:
            w = self.spec.window_of(source)
            lo, hi = w.bounds()
            rows = scan_window(self.catalog, self.spec, source).agg(F.count(F.lit(1)).alias("rows_in_window"))
            parts.append(rows.select(
                F.lit(source.name).alias("source"), F.lit(source.table).alias("source_table"),
                lo.alias("window_start"), hi.alias("window_end"),
                label(lo).alias("start_label"), label(hi).alias("end_label"),
                day_label(hi).alias("generated_on"), "rows_in_window"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
