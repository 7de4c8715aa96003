"""The same report declared over the provided TPC-H-style tables.

Role mapping (FIXTURES.md §3):

* entity  = ``nation`` (id, name), allow-list 1..23;
* bridge  = ``DISTINCT (c_nationkey, c_mktsegment)`` of ``customer``;
* account = ``customer``, not real (``dummy = 1``) when ``c_acctbal < 0``;
* facts   = ``events`` (by ``user_id``), ``orders`` (by ``o_custkey``) and ``lineitem`` reached
  through ``orders`` as a header.

Events report on the day that closes 2024-01-16 08:00; orders and line items are sparse,
so they use a 30-day lookback that closes 1998-07-01 08:00.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.window import ReportWindow
from ..operators.specs import CONSTANT, PAIRS, Child, Header, Metric, ReportSpec, Source, SpineSpec
from ..sources.catalog import Catalog
from .layout import COLUMN_OF, MODULE_OF, MODULES

# Fixed values of the fixture mapping.
EVENT_WINDOW = ReportWindow(datetime(2024, 1, 16, 8, 0, 0), timedelta(days=1))
ORDER_WINDOW = ReportWindow(datetime(1998, 7, 1, 8, 0, 0), timedelta(days=30))
ALLOW = tuple(range(1, 24))
DUMMY = "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END"
ORDER_FLAG = "CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 END"
CURRENT_REGION = 1

# Declared schemas of the tables the report reads: no footer inference at load time, and a
# drifting file schema fails loudly instead of silently changing types.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

SPINE = SpineSpec(
    entity_table="nation", entity_id="n_nationkey", entity_name="n_name",
    bridge_table="customer", bridge_entity="c_nationkey", bridge_keys=("c_nationkey", "c_mktsegment"),
    bridge_distinct=True,
    account_table="customer", account_id="c_custkey", account_keys=("c_nationkey", "c_mktsegment"),
    account_dummy=DUMMY,
)

SOURCES = (
    Source("events", "events", "user_id", "ts", window=EVENT_WINDOW),
    Source("orders", "orders", "o_custkey", "o_orderdate", window=ORDER_WINDOW),
    Source("shipments", "lineitem", "", "l_shipdate", window=ORDER_WINDOW,
           header=Header("orders", "o_orderkey", "o_custkey", "l_orderkey")),
)

# Metric key → (source, counted expression, extra predicate, account flag placement).
_DISTINCT = {
    "metric_attendance": ("events", "event_id", "event_type = 'view'", "on"),
    "metric_hook_search": ("shipments", "l_orderkey * 10 + l_linenumber", None, "where"),
    "metric_teach_studio": ("events", "event_id", "event_type = 'click'", "where"),
    "metric_live_assignment": ("events", "event_id", "event_type = 'purchase'", "on"),
    "metric_live_survey": ("events", "event_id", "event_type = 'signup'", "on"),
    "metric_notifications": ("events", "event_id", "event_type = 'error'", "on"),
    "metric_live_class": ("orders", "o_orderkey", "o_orderpriority = '1-URGENT'", "on"),
    "metric_case_study": ("orders", "o_orderkey", "o_orderpriority = '2-HIGH'", "on"),
    "metric_projects": ("orders", "o_orderkey", "o_orderpriority = '3-MEDIUM'", "on"),
    "metric_arena": ("orders", "o_orderkey", "o_orderpriority = '4-NOT SPECIFIED'", "on"),
    "metric_gocode": ("events", "get_json_object(props, '$.k')", None, "on"),
    "metric_objective": ("orders", "o_orderkey", None, "on"),
    "metric_subjective": ("orders", "o_orderkey", f"{ORDER_FLAG} = 0", "on"),
    "metric_coding": ("orders", "o_orderkey", "o_orderpriority = '5-LOW'", "on"),
    "metric_assignment": ("orders", "o_orderkey", f"{ORDER_FLAG} = 1", "on"),
    "metric_regular_feedback": ("events", "event_id", "value < 20", "on"),
    "metric_semester_feedback": ("events", "event_id", "value BETWEEN 20 AND 80", "on"),
    "metric_unit_feedback": ("events", "event_id", "value > 80", "on"),
}


def metrics() -> tuple[Metric, ...]:
    out = []
    for key in MODULE_OF:
        module, column = MODULE_OF[key], COLUMN_OF[key]
        if key in _DISTINCT:
            source, value, where, placement = _DISTINCT[key]
            out.append(Metric(key, module, column, source, value=value, where=where, account_filter=placement))
        elif key == "metric_analyse":
            out.append(Metric(key, module, column, measure=CONSTANT, constant=0))
        elif key == "metric_remediate":
            out.append(Metric(key, module, column, "orders", measure=PAIRS, value="o_orderkey",
                              where="o_orderstatus = 'F'", child=Child("lineitem", "l_orderkey", "l_linenumber")))
    return tuple(out)


def report_spec() -> ReportSpec:
    return ReportSpec(spine=SPINE, sources=SOURCES, metrics=metrics(), modules=MODULES, window=EVENT_WINDOW,
                      allow=ALLOW)


def entities_current_year(catalog: Catalog) -> DataFrame:
    """nation ⋈ region (current = region 1) ⋈ customer → DISTINCT (entity, name, region name).

    The customer side only contributes existence, so it is reduced to its distinct nation
    keys first (a map-side partial aggregate) instead of joining every customer row.
    """
    region = catalog.table("region").where(F.col("r_regionkey") == CURRENT_REGION).select(
        F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("name"))
    nation = catalog.table("nation").select(
        F.col("n_nationkey").alias("college_id"), F.col("n_name").alias("college_name"),
        F.col("n_regionkey").alias("region_key"))
    present = catalog.table("customer").select(F.col("c_nationkey").alias("college_id")).distinct()
    return (nation.join(region, "region_key").join(present, "college_id")
            .select("college_id", "college_name", "name").distinct())
