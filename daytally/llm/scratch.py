"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the setting is absent and the session runs in one process (``local[...]``, as
    in tests) a temporary folder takes its place; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daytally-checkpoint-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside are deleted at the end, also after a failure.

    For a caller that has its result written by then: an operator's frame reads the tables that it cut
    until its last action.  Blocks may be nested; each deletes its own tables.
    """
    made: list[str] = []
    token = _temporary.set(made)
    try:
        yield
    finally:
        _temporary.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return it reread.

    What follows neither recomputes ``df`` nor depends on the executors that made it.  With ``keep`` the
    table stays when a ``temporary`` block around it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _temporary.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
