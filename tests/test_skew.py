"""A third of all activity on one account (and so one entity): same numbers on every path."""

from __future__ import annotations

from dataclasses import replace

import pytest

from daytally import Catalog, DailyReport
from daytally.plans import fixture

from .conftest import SF01

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed_catalog(spark):
    events = spark.read.schema(fixture.SCHEMAS["events"]).parquet(f"{SF01}/events.parquet")
    hot = events.where("ts BETWEEN TIMESTAMP_NTZ '2024-01-15 08:00:00' AND TIMESTAMP_NTZ '2024-01-16 08:00:00'")
    # Move a third of the day's events (and copies of them) onto one real account of entity 1.
    hot_user = spark.read.parquet(f"{SF01}/customer.parquet").where(
        "c_nationkey = 1 AND c_acctbal >= 0").agg({"c_custkey": "min"}).first()[0]
    extra = hot.selectExpr("event_id + 1000000 AS event_id", "ts", f"CAST({hot_user} AS BIGINT) AS user_id",
                           "event_type", "value", "props")
    skewed = events.unionByName(extra).unionByName(extra.selectExpr("event_id + 1000000 AS event_id", "ts",
                                                                    "user_id", "event_type", "value", "props"))
    cat = Catalog.parquet_dir(spark, SF01, schemas=fixture.SCHEMAS)
    cat._loaded["events"] = skewed
    return cat


def test_hot_account_same_numbers_broadcast_and_shuffled(spark, skewed_catalog):
    spec = fixture.report_spec()
    broadcast = DailyReport(skewed_catalog, spec)
    want = sorted(broadcast.detail().collect())

    previous = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        shuffled = DailyReport(skewed_catalog, replace(spec, key_filter_above=0))
        df = shuffled.detail()
        got = sorted(df.collect())
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want
    # The fact → account join shuffled, and the hot account's partition was split at run time.
    assert "SortMergeJoin(skew=true)" in final_plan and "AQEShuffleRead skewed" in final_plan
