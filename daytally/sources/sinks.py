"""Report sinks: the detail and summary tables, partitioned by report date, replaced together.

A rerun of one day replaces only that day's partition, also when the rerun has no rows, so
backfills and retries are idempotent and never touch other days.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, days: date | Iterable[date], *, fmt: str = "parquet",
                      partition_col: str = "report_date", order_by: list[str] | None = None) -> None:
    """Replace ``days`` of the table under ``path``, which is partitioned by report day.

    With one day every row of ``df`` belongs to it; with several ``df`` carries the day in
    ``partition_col`` (ISO text or DATE), as a backfill does.  Each day is one file, its rows in the
    order of the SQL expressions ``order_by``.  A day without rows is left empty, not stale.
    """
    order = [F.expr(e) for e in order_by or []]
    if isinstance(days, date):
        (df.coalesce(1).sortWithinPartitions(*order) if order else df.coalesce(1)).write.mode("overwrite").format(
            fmt).save(_folder(path, partition_col, days))
        return
    dated = df.withColumn(partition_col, F.col(partition_col).cast("date"))
    (dated.repartition(partition_col)  # one small file per report day, not one per shuffle partition
     .sortWithinPartitions(partition_col, *order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).format(fmt)
     .save(path))
    written = {r[0] for r in dated.select(partition_col).distinct().collect()}  # at most one row per day
    for day in set(days) - written:
        df.drop(partition_col).limit(0).coalesce(1).write.mode("overwrite").format(fmt).save(
            _folder(path, partition_col, day))


STAGING = "_staged"
MARKER = "_COMMITTED"


class Staged:
    """Several tables' days, replaced together: written aside, marked, then moved into place.

    ``with Staged(spark, out, tables) as s`` writes below ``s.path(table)``.  Until the marker is written the
    published days are untouched, and a failed run's folder is dropped.  The marker is the commit: every
    later step only moves folders, and ``publish`` takes up a run that ended between two moves where it
    stopped.  Each day's folder is swapped for the new one; other days are never touched.
    """

    def __init__(self, spark: SparkSession, out: str, tables: Iterable[str]):
        self.spark, self.out, self.tables = spark, out.rstrip("/"), tuple(tables)
        # Runs publish in the order of their names.
        self.run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        self.root = f"{self.out}/{STAGING}/{self.run}"

    def path(self, table: str) -> str:
        if table not in self.tables:
            raise KeyError(table)
        return f"{self.root}/new/{table}"

    def __enter__(self) -> "Staged":
        publish(self.spark, self.out)  # a committed run that did not get to its end
        return self

    def __exit__(self, failed, *_) -> None:
        fs, path = _fs(self.spark, self.root)
        if failed is not None:
            fs.delete(path(self.root), True)
            return
        fs.create(path(f"{self.root}/{MARKER}"), True).close()
        publish(self.spark, self.out)


def publish(spark: SparkSession, out: str) -> list[str]:
    """Move the days of all committed runs into place, oldest first; returns the runs' names."""
    staging = f"{out.rstrip('/')}/{STAGING}"
    fs, path = _fs(spark, staging)
    if not fs.exists(path(staging)):
        return []
    done = []
    for run in sorted(_names(fs, path(staging))):
        root = f"{staging}/{run}"
        if not fs.exists(path(f"{root}/{MARKER}")):
            continue  # still being written, or abandoned
        for table in _names(fs, path(f"{root}/new")):
            for day in sorted(n for n in _names(fs, path(f"{root}/new/{table}")) if "=" in n):
                source, target, old = f"{root}/new/{table}/{day}", f"{out.rstrip('/')}/{table}/{day}", f"{root}/old/{table}/{day}"
                if fs.exists(path(target)):
                    fs.mkdirs(path(old).getParent())
                    _move(fs, path(target), path(old))
                fs.mkdirs(path(target).getParent())
                _move(fs, path(source), path(target))
        fs.delete(path(root), True)
        done.append(run)
    return done


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` and its path constructor."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _names(fs, path) -> list[str]:
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _folder(path: str, partition_col: str, day: date) -> str:
    return f"{path}/{partition_col}={day.isoformat()}"


# Row order of the two report tables inside a day's file.
DETAIL_ORDER = ["s_no"]
SUMMARY_ORDER = ["s_no = 'Total'", "try_cast(s_no AS BIGINT)"]
