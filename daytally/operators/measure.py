"""Evaluate many metrics in one plan.

For every source, one scan: filter the closed window (pushed to the scan), keep the account id, the
counted value and a bit per metric whose predicate the row meets.  Then, for all of them together:

* join the account → entity map once (Spark chooses broadcast or shuffle by its size in bytes);
* ``groupBy(entity, counted expression, value)`` with ``bit_or`` of the metric bits: one row per
  distinct key crosses the network, whatever the number of metrics, and repeated rows count once.
  The shuffle is hashed on the value too, so one entity holding most of the activity still
  spreads over all partitions;
* one ``groupBy(entity)`` with a conditional sum per metric (partial aggregation on the map side, so
  each task ships at most one row per entity) – no ``Expand``, and a row copy only where a source counts
  several expressions.

Where a windowed side meets a table that is not windowed (a header, a pair metric's child), that table's
scan is reduced to the windowed side's keys first (see :mod:`.keyfilter`): no account, entity or row
of its history that the window does not touch is shuffled, and no job runs while a query is built.

Pair metrics (``COUNT`` of parent ⟕ child rows) map the window's parents to entities first; the reduced
child is counted per parent key on the map side, so a parent with a huge fan-out is a row per task.

A backfill measures several daily windows in one scan: a key keeps the distinct (first run, last run,
metric bits) of its rows, and is spread over the runs only after the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..sources.catalog import Catalog
from .keyfilter import reduced
from .spine import account_map, department_map, entities
from .specs import DISTINCT, PAIRS, Metric, ReportSpec, Source

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


MAX_METRICS = 62
"""Metric bits in one BIGINT mask."""


def _bit(mid: int) -> str:
    return f"CAST({1 << mid} AS BIGINT)"


@dataclass(frozen=True)
class KeyGroup:
    """The metrics of a source that count the same expression."""

    number: int
    value: str
    integral: bool
    metrics: tuple[tuple[int, Metric], ...]

    def keep(self) -> str:
        """Rows that any of the metrics counts."""
        if all(m.where for _, m in self.metrics):
            return f"({self.value}) IS NOT NULL AND (" + " OR ".join(f"({m.where})" for _, m in self.metrics) + ")"
        return f"({self.value}) IS NOT NULL"

    def columns(self) -> dict[str, str]:
        """g, k_num, k_str and the mask with the bits of the metrics whose predicate holds."""
        num, text = (("CAST({0} AS BIGINT)", "CAST(NULL AS STRING)") if self.integral
                     else ("CAST(NULL AS BIGINT)", "CAST({0} AS STRING)"))
        bits = [f"CASE WHEN {m.where} THEN {_bit(i)} ELSE CAST(0 AS BIGINT) END" if m.where else _bit(i)
                for i, m in self.metrics]
        return {"g": str(self.number), "k_num": num.format(f"({self.value})"),
                "k_str": text.format(f"({self.value})"), "mask": " | ".join(f"({b})" for b in bits)}


def _flagged(src_df: DataFrame, groups: list[KeyGroup], link: str, carry: list[str]) -> DataFrame:
    """Rows (link, [run range], g, k_num, k_str, mask): one per source row and key group that counts it."""
    src_df = src_df.where(" OR ".join(f"({g.keep()})" for g in groups))
    if len(groups) == 1:
        return src_df.selectExpr(f"{link} AS link", *carry, *[f"{e} AS {n}" for n, e in groups[0].columns().items()])
    # Several counted expressions: still one scan, each row once per expression.
    rows = ", ".join("named_struct(" + ", ".join(f"'{n}', {e}" for n, e in g.columns().items()) + ")" for g in groups)
    return (src_df.selectExpr(f"{link} AS link", *carry, f"inline(array({rows}))")
            .where("mask <> 0 AND (k_num IS NOT NULL OR k_str IS NOT NULL)"))


RUN = "_run"
RANGE = ["_first", "_last"]
LATER = "_later"


def scan_window(catalog: Catalog, spec: ReportSpec, source: Source, runs: int = 1) -> DataFrame:
    """The source's rows inside its closed window; the bounds are pushed to the scan, and a
    date-partitioned source also gets the partition predicate so whole days are pruned.

    With ``runs > 1`` the scan covers the window and the ``runs - 1`` daily windows before it;
    ``_first`` and ``_last`` are the runs (0 is the latest day) whose window holds the row."""
    window = spec.window_of(source)
    span = window.widened(runs)
    df = catalog.scan(source.table, source.time, span.start, span.end)
    if source.date_partition:
        df = df.where(span.partition_days_sql(source.date_partition))
    df = df.where(span.contains_sql(source.time))
    if runs > 1:
        first, last = window.run_range_sql(source.time, runs)
        df = df.selectExpr("*", f"{first} AS {RANGE[0]}", f"{last} AS {RANGE[1]}").where(f"{RANGE[0]} <= {RANGE[1]}")
    return df


class Measure:
    """Builds the wide (entity_id, <metric columns>) frame for a subset of metrics."""

    def __init__(self, catalog: Catalog, spec: ReportSpec):
        self.catalog = catalog
        self.spec = spec
        self.entities = entities(catalog, spec.spine, spec.allow)
        self.departments = department_map(catalog, spec.spine, spec.allow)
        self.account_map = account_map(catalog, spec.spine, self.departments)
        self._integral: dict[tuple[str, str], bool] = {}

    # -- types -------------------------------------------------------------------------

    def _types(self, source: Source, values: list[str]) -> dict[str, bool]:
        todo = [v for v in dict.fromkeys(values) if (source.name, v) not in self._integral]
        if todo:
            schema = self.catalog.table(source.table).select(*[F.expr(v) for v in todo]).schema
            for v, field in zip(todo, schema.fields):
                self._integral[(source.name, v)] = isinstance(field.dataType, _INTEGRAL)
        return {v: self._integral[(source.name, v)] for v in values}

    # -- plan pieces -------------------------------------------------------------------

    def _reduced(self, df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
        return reduced(df, column, keys, key, above=self.spec.key_filter_above, bits=self.spec.key_filter_bits)

    def _through_header(self, source: Source, leaf: DataFrame) -> DataFrame:
        """Leaf rows keyed by header id → the same rows keyed by account.

        The header table is not windowed and is as large as a fact table: it is reduced to the leaf's
        links and joined to the leaf before any account is looked up, so it never moves on the account.
        """
        h = source.header
        header = (self.catalog.table(h.table).selectExpr(f"{h.id} AS h_id", f"{h.account} AS h_account")
                  .where("h_id IS NOT NULL AND h_account IS NOT NULL"))
        header = self._reduced(header, "h_id", leaf, "link")
        return (leaf.join(header, leaf.link == header.h_id).drop("h_id", "link").withColumnRenamed("h_account", "link"))

    def _pair_rows(self, mid: int, metric: Metric, runs: int, later: bool = False) -> DataFrame:
        """(entity_id, [_run], mask, n): n counts parent ⟕ child rows with both ids present.

        With ``later`` and several runs, ``_later`` tells the parents after the window's start from those on it.

        The window's parents are mapped to entities; the child, which is not windowed, is reduced to
        the parents' ids, counted per id (map-side partial aggregate) and joined.
        """
        source, child = self.spec.source_by_name[metric.source], metric.child
        cond = " AND ".join(([f"({metric.where})"] if metric.where else [])
                            + [f"({metric.value}) IS NOT NULL", f"({source.account}) IS NOT NULL"])
        rows = scan_window(self.catalog, self.spec, source, runs).where(cond)
        runs_of = [f"explode(sequence({RANGE[0]}, {RANGE[1]})) AS {RUN}"] if runs > 1 else []
        carry = [RUN] if runs > 1 else []
        if runs > 1 and later:
            start = self.spec.window_of(source).start.strftime("%Y-%m-%d %H:%M:%S.%f")
            rows = rows.selectExpr("*", f"CAST({source.time} AS TIMESTAMP_NTZ) AS _at")
            runs_of.append("_at")
            carry.append(LATER)
        ids = rows.selectExpr(f"{metric.value} AS p_id")
        rows = rows.selectExpr(f"{source.account} AS p_account", f"{metric.value} AS p_id", *runs_of)
        if LATER in carry:
            rows = rows.selectExpr("*", f"_at > TIMESTAMP_NTZ '{start}' - make_dt_interval({RUN}) AS {LATER}")
        amap = self.account_map
        parents = (rows.join(amap, rows.p_account == amap.account_id).groupBy("p_id", "entity_id", *carry)
                   .agg(F.count(F.lit(1)).alias("copies")))
        kids = (self.catalog.table(child.table).where(f"({child.id}) IS NOT NULL AND ({child.link}) IS NOT NULL")
                .selectExpr(f"{child.link} AS c_link"))
        fanout = (self._reduced(kids, "c_link", ids, "p_id").groupBy("c_link").agg(F.count(F.lit(1)).alias("kids")))
        return (parents.join(fanout, parents.p_id == fanout.c_link)
                .selectExpr("entity_id", *carry, f"{_bit(mid)} AS mask", "copies * kids AS n"))

    def _distinct_rows(self, rows: DataFrame, runs: int) -> DataFrame:
        """(entity_id, [_run], mask, n): one row per distinct key (and run) with the bits of its metrics."""
        keys = ["entity_id", "g", "k_num", "k_str"]
        if runs == 1:
            one = rows.groupBy(*keys).agg(F.bit_or("mask").alias("mask"))
            return one.selectExpr("entity_id", "mask", "CAST(1 AS BIGINT) AS n")
        # A key's rows differ by at most runs x runs ranges and the masks of its source.
        spans = rows.groupBy(*keys).agg(F.collect_set(F.struct(*RANGE, "mask")).alias("spans"))
        per_run = (f"transform(sequence(0, {runs - 1}), r -> aggregate(filter(spans, s -> s.{RANGE[0]} <= r AND "
                   f"r <= s.{RANGE[1]}), CAST(0 AS BIGINT), (a, s) -> a | s.mask))")
        return (spans.selectExpr("entity_id", f"posexplode({per_run}) AS ({RUN}, mask)").where("mask <> 0")
                .selectExpr("entity_id", RUN, "mask", "CAST(1 AS BIGINT) AS n"))

    def keyed_rows(self, numbered: list[tuple[int, Metric]], runs: int) -> DataFrame | None:
        """(entity_id, [_first, _last], g, k_num, k_str, mask): the windows' rows of all distinct-count metrics.

        One scan per source, one key group per counted expression, one join with the account map.
        """
        by_source: dict[str, dict[str, list[tuple[int, Metric]]]] = {}
        for mid, m in numbered:
            if m.measure == DISTINCT:
                by_source.setdefault(m.source, {}).setdefault(m.value, []).append((mid, m))
        found: list[DataFrame] = []
        number = 0
        for name, values in by_source.items():
            source = self.spec.source_by_name[name]
            integral = self._types(source, list(values))
            groups = [KeyGroup(number + k, v, integral[v], tuple(ms)) for k, (v, ms) in enumerate(values.items())]
            number += len(groups)
            rows = _flagged(scan_window(self.catalog, self.spec, source, runs), groups,
                            source.header.link if source.header else source.account, RANGE if runs > 1 else [])
            found.append(self._through_header(source, rows) if source.header else rows)
        if not found:
            return None
        rows = reduce(DataFrame.unionByName, found)
        return rows.join(self.account_map, rows.link == self.account_map.account_id).drop("link", "account_id")

    # -- the wide frame ----------------------------------------------------------------

    def wide(self, metrics: list[Metric], runs: int = 1) -> DataFrame:
        """One row per allow-listed entity: entity_id, entity_name and
        one nullable bigint column per measured metric.  With ``runs > 1``, one row per entity
        and run, with the run offset in ``_run`` (the daily window moved that many days back).

        The base ids enter the final aggregate as zero-valued rows, so entities without activity
        are kept; the aggregate holds only numbers (a hash aggregate: a string ``max`` would force
        a sort-based aggregate that sorts every deduplicated row on the map side), and the
        names come from the entity base joined to the per-entity result.
        """
        base = self.entities
        carry = [RUN] if runs > 1 else []
        base_rows = base.selectExpr("*", f"explode(sequence(0, {runs - 1})) AS {RUN}") if runs > 1 else base
        numbered = [(i, m) for i, m in enumerate(metrics) if m.measure in (DISTINCT, PAIRS)]
        if not numbered:
            return base_rows
        if numbered[-1][0] > MAX_METRICS:
            raise ValueError(f"at most {MAX_METRICS + 1} metrics can be measured in one plan")
        pairs = [(i, m) for i, m in numbered if m.measure == PAIRS]

        parts = []
        rows = self.keyed_rows(numbered, runs)
        if rows is not None:
            parts.append(self._distinct_rows(rows, runs))
        parts += [self._pair_rows(i, m, runs) for i, m in pairs]
        long = reduce(DataFrame.unionByName, parts)
        long = long.unionByName(base_rows.selectExpr("entity_id", *carry, "CAST(0 AS BIGINT) AS mask",
                                                     "CAST(0 AS BIGINT) AS n"))
        per_entity = long.groupBy("entity_id", *carry).agg(
            *[F.expr(f"sum(CASE WHEN (mask & {_bit(i)}) <> 0 THEN n END) AS `{m.column}`") for i, m in numbered])
        return per_entity.join(base, "entity_id")
