"""Name → DataFrame resolution.

The report plans never open files themselves; they ask a :class:`Catalog` for a table by
its logical name and select only the columns they need.  Whatever backs the name
(Parquet files, a JDBC table, a frame built in a test) is hidden here, so column pruning
and filter pushdown reach the real scan through Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .jdbc import JdbcConfig, asked_bounds, read_jdbc, read_jdbc_window, with_key_ranges


@dataclass
class Catalog:
    spark: SparkSession
    root: str | None = None
    paths: Mapping[str, str] = field(default_factory=dict)
    frames: Mapping[str, DataFrame] = field(default_factory=dict)
    schemas: Mapping[str, StructType | str] = field(default_factory=dict)  # StructType or DDL text
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)  # required, where no schema is declared
    kinds: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # table -> column -> "time" or "integer"
    jdbc: JdbcConfig | None = None
    bounds: Callable[[str], list[tuple]] | None = None  # answers a key bounds statement; default: over JDBC
    fmt: str = "parquet"
    _loaded: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False)

    @classmethod
    def parquet_dir(cls, spark: SparkSession, root: str, **kw) -> "Catalog":
        return cls(spark, root=root, **kw)

    @classmethod
    def in_memory(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "Catalog":
        return cls(spark, frames=dict(frames))

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if self.root is None:
            raise KeyError(f"no location for table {name!r}")
        for candidate in (f"{self.root}/{name}.{self.fmt}", f"{self.root}/{name}"):
            if _exists(self.spark, candidate):
                return candidate
        return f"{self.root}/{name}.{self.fmt}"

    def table(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame; resolved once per catalog (file listing, footer schema).

        The files must have all declared columns: under a declared schema a renamed column would
        otherwise read as NULL and count as zero.
        """
        if name in self.frames:
            return self.frames[name]
        if name not in self._loaded:
            if self.jdbc is not None and name not in self.paths and self.root is None:
                if name in self.jdbc.keys:  # one query for all tables' key bounds, when the first of them is read
                    self.jdbc = with_key_ranges(self.jdbc, self.bounds or asked_bounds(self.spark, self.jdbc))
                self._loaded[name] = read_jdbc(self.spark, self.jdbc, name)
            else:
                path = self.path(name)
                reader = self.spark.read.format(self.fmt)
                if name in self.schemas:
                    declared = self.schemas[name]
                    if isinstance(declared, str):
                        declared = StructType.fromDDL(declared)
                    _require_columns(self.spark, self.fmt, path, declared.names)
                    _require_types(path, _file_schema(self.spark, self.fmt, path), declared)
                    reader = reader.schema(_with_partitions(self.spark, self.fmt, path, declared))
                elif name in self.columns:
                    _require_columns(self.spark, self.fmt, path, self.columns[name])
                    _require_kinds(path, _file_schema(self.spark, self.fmt, path), self.kinds.get(name, {}))
                self._loaded[name] = reader.load(path)
        return self._loaded[name]

    def scan(self, name: str, time_col: str, start: datetime, end: datetime) -> DataFrame:
        """The table for a windowed read.  Files: the table itself (the caller's window filter
        is pushed to the scan).  JDBC with ``time_slices``: parallel time-range queries that
        cover ``[start, end]``; the caller still applies the exact window."""
        if (name not in self.frames and name not in self.paths and self.root is None
                and self.jdbc is not None and (self.jdbc.time_slices > 0 or name in self.jdbc.instants)):
            return read_jdbc_window(self.spark, self.jdbc, name, time_col, start, end)
        return self.table(name)

    def register_views(self, names: list[str]) -> None:
        for name in names:
            self.table(name).createOrReplaceTempView(name)

    def sql(self, text: str, tables: list[str]) -> DataFrame:
        """Run Spark SQL over catalog tables (registered as temp views); errors raise."""
        self.register_views(tables)
        return self.spark.sql(text)


_file_schemas: dict[tuple[str, str], StructType] = {}


def _file_schema(spark: SparkSession, fmt: str, path: str) -> StructType:
    """The schema that the files at ``path`` carry (one footer, read once per application and path)."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _file_schemas:
        _file_schemas[key] = spark.read.format(fmt).load(path).schema
    return _file_schemas[key]


def _require_columns(spark: SparkSession, fmt: str, path: str, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in _file_schema(spark, fmt, path).names]
    if missing:
        raise ValueError(f"{path} lacks the declared columns {', '.join(missing)}")


# What a file's type may be where another one is declared: the reader widens these without loss or shift.
_WIDENS = {
    "short": {"byte"}, "integer": {"byte", "short"}, "long": {"byte", "short", "integer"},
    "double": {"float", "byte", "short", "integer"}, "float": {"byte", "short"},
    "timestamp_ntz": {"date"},
}
# An instant is wall-clock time only in the session's zone, which the job sets to the report's.
_KINDS = {"time": {"timestamp_ntz", "timestamp", "date"}, "integer": {"byte", "short", "integer", "long"}}


def _require_types(path: str, found: StructType, declared: StructType) -> None:
    """A file's column of another type raises unless the reader widens it: text where a time is declared would read
    as NULL or fail late, and an instant would be taken for wall-clock time."""
    wrong = []
    for want in declared.fields:
        have = found[want.name].dataType
        if have != want.dataType and have.typeName() not in _WIDENS.get(want.dataType.typeName(), ()):
            wrong.append(f"{want.name} is {have.simpleString()}, declared {want.dataType.simpleString()}")
    if wrong:
        raise ValueError(f"{path}: {'; '.join(wrong)}")


def _require_kinds(path: str, found: StructType, kinds: Mapping[str, str]) -> None:
    """The same where only the kind of a column is declared."""
    wrong = [f"{c} is {found[c].dataType.simpleString()}, not a column of kind {kind}" for c, kind in kinds.items()
             if c in found.names and found[c].dataType.typeName() not in _KINDS[kind]]
    if wrong:
        raise ValueError(f"{path}: {'; '.join(wrong)}")


def _with_partitions(spark: SparkSession, fmt: str, path: str, declared: StructType) -> StructType:
    """The declared columns and the files' other DATE columns (a day partition has one)."""
    extra = [f for f in _file_schema(spark, fmt, path).fields
             if f.name not in declared.names and f.dataType.typeName() == "date"]
    return StructType([*declared.fields, *extra])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can see ``path``, whatever store it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
