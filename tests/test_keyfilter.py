"""The bitmap of keys: no key is lost, nearly all others go, and what cannot be hashed alike is left alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daytally.operators.keyfilter import bitmap, estimated_bytes, reduced

from .conftest import SF01


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "date"])
def test_no_key_is_lost_and_few_others_stay(spark, kind):
    value = "date_add(DATE '1000-01-01', CAST(id AS INT))" if kind == "date" else f"CAST(id AS {kind})"
    rows = spark.range(40_000).selectExpr(f"{value} AS k", "id").unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, -1L AS id"))
    keys = rows.where("id % 40 = 0").select(F.col("k").alias("x")).unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS x"))
    left = [r.id for r in reduced(rows, "k", keys, "x", above=0, bits=1 << 14).collect()]
    assert set(range(0, 40_000, 40)) <= set(left) and len(left) == len(set(left)) < 1000 + 0.02 * 40_000 and -1 not in left


def test_integers_of_different_width_meet(spark):
    wide, narrow = spark.range(100).selectExpr("id AS k"), spark.range(10, 20).selectExpr("CAST(id AS SMALLINT) AS x")
    assert set(range(10, 20)) <= {r.k for r in reduced(wide, "k", narrow, "x", above=0).collect()}
    assert reduced(wide, "k", narrow, "x", above=0).count() < 15


def test_left_alone(spark):
    rows = spark.range(100).selectExpr("id AS k")
    decimal = spark.range(5).selectExpr("CAST(id AS DECIMAL(10,0)) AS x")
    assert reduced(rows, "k", decimal, "x", above=0) is rows  # 1 and 1.0 are equal but hash apart
    assert reduced(rows, "k", rows, "k", above=estimated_bytes(rows) + 1) is rows
    assert reduced(rows, "k", rows.limit(0), "k", above=0).count() == 0
    for bits in (0, 100, 1 << 40):
        with pytest.raises(ValueError):
            reduced(rows, "k", rows, "k", above=0, bits=bits)


def test_more_keys_than_bits_drop_nothing(spark):
    rows = spark.range(5000).selectExpr("id AS k")
    assert reduced(rows, "k", rows, "k", above=0, bits=64).count() == 5000
    assert len(bitmap(rows, "k", 128).first().bits) == 2


def test_a_windows_parents_reduce_the_childs_history(spark):
    """What is left of the child's scan follows the window, not the history."""
    child = spark.read.parquet(f"{SF01}/lineitem.parquet").selectExpr("l_orderkey AS k")
    window = (spark.read.parquet(f"{SF01}/orders.parquet")
              .where("o_orderdate BETWEEN TIMESTAMP_NTZ '1998-06-01 08:00:00' AND TIMESTAMP_NTZ '1998-07-01 08:00:00'")
              .selectExpr("o_orderkey AS x"))
    wanted = child.join(window, child.k == window.x, "left_semi").count()
    left = reduced(child, "k", window, "x", above=0)
    assert 0 < wanted <= left.count() <= wanted + 0.01 * child.count() < 0.1 * child.count()
    assert left.join(window, left.k == window.x, "left_semi").count() == wanted
