"""Declarative description of a report.

A report is a spine (entity → bridge → real accounts) plus a list of metrics.  Each metric
counts rows of a *source* that fall in the report window and belong to an account of the
entity.  Expressions are Spark SQL strings so a registry can be written as data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.window import ReportWindow

DISTINCT = "distinct"   # COUNT(DISTINCT value)
PAIRS = "pairs"         # COUNT of parent ⟕ child rows where both ids are present
CONSTANT = "constant"   # a fixed number per entity


@dataclass(frozen=True)
class SpineSpec:
    """entity ⟕ bridge ⟕ account, with the account's ``dummy`` flag."""

    entity_table: str
    entity_id: str
    entity_name: str
    bridge_table: str
    bridge_entity: str
    bridge_keys: tuple[str, ...]        # bridge columns the account refers to
    account_table: str
    account_id: str
    account_keys: tuple[str, ...]       # account columns, pairwise equal to bridge_keys
    account_dummy: str                  # 0 = real account
    bridge_distinct: bool = False       # bridge is derived with DISTINCT


@dataclass(frozen=True)
class Header:
    """Leaf rows reach the account through a header table (leaf.link = header.id)."""

    table: str
    id: str
    account: str
    link: str


@dataclass(frozen=True)
class Child:
    """Child rows of a parent source for pair counting (child.link = parent value)."""

    table: str
    link: str
    id: str


@dataclass(frozen=True)
class Source:
    name: str
    table: str
    account: str                        # account id expression (on the leaf when no header)
    time: str                           # column tested against the closed window
    window: ReportWindow | None = None  # overrides the report window for this source
    header: Header | None = None
    date_partition: str | None = None   # DATE partition column holding date(time): enables partition pruning


@dataclass(frozen=True)
class Metric:
    key: str                             # name of the single-metric query
    module: str
    column: str                          # output column
    source: str | None = None
    measure: str = DISTINCT
    value: str | None = None             # counted expression (DISTINCT) or parent id (PAIRS)
    where: str | None = None             # extra predicate on source rows
    account_filter: str = "on"           # "where": entities with no real account drop out of the raw metric
    child: Child | None = None
    constant: int = 0


@dataclass(frozen=True)
class ReportSpec:
    spine: SpineSpec
    sources: tuple[Source, ...]
    metrics: tuple[Metric, ...]          # in output order
    modules: tuple[str, ...]
    window: ReportWindow
    allow: tuple[int, ...] | None = None
    id_col: str = "college_id"
    name_col: str = "college_name"
    usage_col: str = "college_usage"
    key_filter_above: int = 64 << 20     # estimated bytes of a table without a window from which its scan is reduced first
    key_filter_bits: int = 1 << 20       # size of that reduction's bitmap
    source_by_name: dict[str, Source] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "source_by_name", {s.name: s for s in self.sources})
        keys = [m.key for m in self.metrics]
        if len(set(keys)) != len(keys):
            raise ValueError("metric keys must be unique")
        for m in self.metrics:
            if m.module not in self.modules:
                raise ValueError(f"{m.key}: unknown module {m.module!r}")
            if m.measure != CONSTANT and m.source not in self.source_by_name:
                raise ValueError(f"{m.key}: unknown source {m.source!r}")

    def metric(self, key: str) -> Metric:
        for m in self.metrics:
            if m.key == key:
                return m
        raise KeyError(key)

    def module_metrics(self, module: str) -> list[Metric]:
        return [m for m in self.metrics if m.module == module]

    def window_of(self, source: Source) -> ReportWindow:
        return source.window or self.window
