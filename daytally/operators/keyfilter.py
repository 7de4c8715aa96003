"""Semi-join reduction of a large table by a fixed-size filter of the other side's keys.

A windowed side (a day of leaf rows, the window's parents) meets a table that is not windowed
and holds years of rows (headers, children).  The windowed side's keys set ``HASHES`` bits each in a
bitmap of fixed size; the large table's scan drops the rows whose bits are not all set, so what is
joined afterwards is about as large as the windowed side, whatever the history behind it.  A row whose key
occurs is never dropped; a few others pass and go in the join.  With far more keys than bits nothing is
dropped, and the join is what it would have been.

The bitmap is a scalar subquery of the plan: words of 64 bits are combined with ``bit_or`` (map-side
first) and put in order as one array, whose size is ``bits`` / 8 bytes.  Building a query runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType

HASHES = 3
BITS = 1 << 20
MAX_BITS = 1 << 26
"""The array is gathered in one task: at most 8 MB of bits."""

INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_SAME = (StringType, DateType, TimestampType, TimestampNTZType)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size (file sizes scaled to the columns read); no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative: never."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _hashable(kind: DataType, other: DataType) -> bool:
    """Whether equal keys of the two types hash alike (integers do, once they are widened)."""
    return (isinstance(kind, INTEGRAL) and isinstance(other, INTEGRAL)) or (kind == other and isinstance(kind, _SAME))


def _places(key: Column, kind: DataType, bits: int) -> list[Column]:
    key = key.cast("bigint") if isinstance(kind, INTEGRAL) else key
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, one column: the bits of all keys as an array of ``bits`` / 64 integers."""
    place = keys.where(f"{key} IS NOT NULL").select(
        F.explode(F.array(*_places(F.col(key), keys.schema[key].dataType, bits))).alias("place"))
    words = place.select(F.expr("place div 64").alias("word"),
                         F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("mask"))
    none = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    whole = words.unionByName(none).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("bits"))


def reduced(df: DataFrame, column: str, keys: DataFrame, key: str, *, above: int, bits: int = BITS) -> DataFrame:
    """``df`` without most of the rows whose ``column`` is no ``key`` of ``keys``, if ``df`` is estimated at ``above`` bytes or more.

    Key types that could compare equal but hash apart leave ``df`` as it is.
    """
    if bits % 64 or not 64 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be a multiple of 64 up to {MAX_BITS}")
    kind = df.schema[column].dataType
    if not _hashable(kind, keys.schema[key].dataType) or estimated_bytes(df) < above:
        return df
    found = bitmap(keys.select(key), key, bits).scalar()
    for place in _places(F.col(column), kind, bits):
        word = F.get(found, F.call_function("shiftright", place, F.lit(6)).cast("int"))
        bit = F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
        df = df.where(bit == 1)
    return df
