"""JDBC reader for production sources (the original job reads a MySQL schema).

Only the scan is delegated to the database: Spark pushes the column list and the simple
predicates (window bounds, flags) into the generated ``SELECT``, and reads tables in
parallel: windowed facts by time slices of the report window, one query per slice; the others
by ranges of a numeric key, given by hand or cut between the bounds that one query asks for all of them.  A table whose
time column holds instants is read with one database session offset per stretch of the window without a clock
change.  The aggregation itself stays in Spark, so the database is never asked to run the whole report.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions.window import zone_slices


@dataclass(frozen=True)
class Partitioning:
    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = 10_000
    connect_timeout_s: int = 20
    partitioning: dict[str, Partitioning] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)   # numeric key of tables without a window: ranges are asked for
    rows_per_range: int = 1_000_000
    max_ranges: int = 64
    time_slices: int = 0   # > 0: read a windowed table as this many parallel time-range queries
    zone_offset: str = "+00:00"   # the database session's time zone, equal to Spark's at the window's end
    zone: str = "UTC"
    instants: frozenset[str] = frozenset()   # tables whose time column holds instants that the session's zone renders

    @classmethod
    def mysql_from_env(cls, prefix: str = "DB_", **kw) -> "JdbcConfig":
        """Settings from ``{prefix}HOST/PORT/NAME/USER/PASS``; secrets never live in code."""
        env = os.environ
        url = f"jdbc:mysql://{env[prefix + 'HOST']}:{env.get(prefix + 'PORT', '3306')}/{env[prefix + 'NAME']}"
        return cls(url=url, user=env.get(prefix + "USER"), password=env.get(prefix + "PASS"),
                   driver="com.mysql.cj.jdbc.Driver", **kw)


def jdbc_options(cfg: JdbcConfig, table: str) -> dict[str, str]:
    opts = {
        "url": cfg.url,
        "dbtable": table,
        "fetchsize": str(cfg.fetch_size),
        "pushDownPredicate": "true",
        "queryTimeout": "0",
    }
    if cfg.url.startswith("jdbc:mysql:"):
        opts["sessionInitStatement"] = f"SET SESSION time_zone = '{cfg.zone_offset}'"
        opts["connectTimeout"] = str(cfg.connect_timeout_s * 1000)
    if cfg.user is not None:
        opts["user"] = cfg.user
    if cfg.password is not None:
        opts["password"] = cfg.password
    if cfg.driver:
        opts["driver"] = cfg.driver
    part = cfg.partitioning.get(table)
    if part is not None:
        opts.update({
            "partitionColumn": part.column,
            "lowerBound": str(part.lower),
            "upperBound": str(part.upper),
            "numPartitions": str(part.partitions),
        })
    return opts


def key_bounds_sql(keys: Mapping[str, str]) -> str:
    """One statement for the least and greatest key of every table (index look-ups in the database)."""
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, MIN({c}) AS low, MAX({c}) AS high FROM {t}"
                              for t, c in sorted(keys.items()))


def asked_bounds(spark: SparkSession, cfg: JdbcConfig) -> Callable[[str], list[tuple]]:
    """Runs a bounds statement over the configured connection."""
    def run(sql: str) -> list[tuple]:
        opts = {k: v for k, v in jdbc_options(cfg, "").items() if k != "dbtable"}
        return [tuple(r) for r in spark.read.format("jdbc").options(**opts, query=sql).load().collect()]

    return run


def with_key_ranges(cfg: JdbcConfig, run: Callable[[str], list[tuple]]) -> JdbcConfig:
    """``cfg`` with a partitioned read of every table in ``keys``, from one bounds query.

    Ranges given by hand win and are not asked for.  A table gets a range per ``rows_per_range`` keys between its
    bounds, ``max_ranges`` at most; an empty or small one is read as it is.  Bounds only place the
    cuts: rows added meanwhile, and null keys, fall into the outer ranges.
    """
    open_ = {t: c for t, c in cfg.keys.items() if t not in cfg.partitioning}
    if not open_:
        return cfg
    found = {}
    for table, low, high in run(key_bounds_sql(open_)):
        if low is None or high is None:
            continue
        low, high = int(low), int(high)
        ranges = min(cfg.max_ranges, -(-(high - low + 1) // cfg.rows_per_range))
        if ranges > 1:
            found[table] = Partitioning(open_[table], low, high + 1, ranges)
    return replace(cfg, partitioning={**found, **cfg.partitioning}, keys={})


def read_jdbc(spark: SparkSession, cfg: JdbcConfig, table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(cfg, table)).load()


def time_slice_predicates(column: str, start: datetime, end: datetime, slices: int, closed: bool = True) -> list[str]:
    """``slices`` disjoint predicates covering the range ``[start, end]`` exactly once
    (half-open slices, the last one closed if asked), as database-side SQL text."""
    step = (end - start) / slices
    fmt = "%Y-%m-%d %H:%M:%S.%f"
    cuts = [start + step * i for i in range(slices)] + [end]
    preds = []
    for i in range(slices):
        upper = "<=" if closed and i == slices - 1 else "<"
        preds.append(f"{column} >= '{cuts[i].strftime(fmt)}' AND {column} {upper} '{cuts[i + 1].strftime(fmt)}'")
    return preds


def window_reads(cfg: JdbcConfig, table: str, column: str, start: datetime,
                 end: datetime) -> list[tuple[dict[str, str], list[str]]]:
    """The reads of a windowed table: connection options and one predicate per parallel query.

    Wall-clock columns do not depend on the session's zone and take one read.  Instants take one per offset that the
    zone has in the window, each in a session of that offset, so every row arrives in its own day's wall-clock time.
    """
    slices = max(1, cfg.time_slices)
    spans = zone_slices(start, end, cfg.zone) if table in cfg.instants else [(start, end, cfg.zone_offset)]
    reads = []
    for k, (low, high, offset) in enumerate(spans):
        share = max(1, round(slices * ((high - low) / (end - start)))) if len(spans) > 1 else slices
        opts = {o: v for o, v in jdbc_options(replace(cfg, zone_offset=offset), table).items()
                if o not in ("url", "dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
        reads.append((opts, time_slice_predicates(column, low, high, share, closed=k == len(spans) - 1)))
    return reads


def read_jdbc_window(spark: SparkSession, cfg: JdbcConfig, table: str, column: str,
                     start: datetime, end: datetime) -> DataFrame:
    """A windowed table read as ``cfg.time_slices`` parallel queries, one per time slice; each
    query carries its slice predicate (and Spark's pushed filters) to the database."""
    return reduce(DataFrame.union, (spark.read.jdbc(cfg.url, table, predicates=preds, properties=opts)
                                    for opts, preds in window_reads(cfg, table, column, start, end)))
