"""The entity → account spine.

``entity ⟕ bridge ⟕ account(dummy = 0)``: one row per (entity, real account), and a row
with a NULL account for a bridge row (or entity) without a real account.  The spine is
never deduplicated: a repeated bridge row repeats the account, and pair counts depend on
that multiplicity exactly as the original left-join chain does.

The metrics only need its inner part, the account map ``account → entity``.  That is
built as ``real accounts ⋈ department map``, where Spark broadcasts the small department map by
its size, so the large account table streams instead of being shuffled; the full left
chain is built only for the ``spine_active_accounts`` output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog
from .keyfilter import broadcast_limit, estimated_bytes
from .specs import SpineSpec


def entities(catalog: Catalog, spec: SpineSpec, allow: tuple[int, ...] | None) -> DataFrame:
    df = catalog.table(spec.entity_table).select(
        F.expr(spec.entity_id).alias("entity_id"), F.expr(spec.entity_name).alias("entity_name"))
    if allow is not None:
        df = df.where(F.col("entity_id").isin(list(allow)) if allow else F.lit(False))
    return df


def bridge(catalog: Catalog, spec: SpineSpec) -> DataFrame:
    cols = [F.expr(spec.bridge_entity).alias("b_entity")] + [
        F.expr(k).alias(f"b_key{i}") for i, k in enumerate(spec.bridge_keys)]
    df = catalog.table(spec.bridge_table).select(*cols)
    return df.distinct() if spec.bridge_distinct else df


def real_accounts(catalog: Catalog, spec: SpineSpec) -> DataFrame:
    cols = [F.expr(spec.account_id).alias("account_id")] + [
        F.expr(k).alias(f"a_key{i}") for i, k in enumerate(spec.account_keys)]
    # Filter before the left join (the predicate sits in ON in the original SQL); it is
    # pushed to the account scan.  A NULL flag is not a real account.
    return catalog.table(spec.account_table).where(F.expr(spec.account_dummy) == 0).select(*cols)


def build_spine(catalog: Catalog, spec: SpineSpec, departments: DataFrame, entity_base: DataFrame) -> DataFrame:
    """Columns: entity_id, entity_name, account_id – the rows of the left chain
    ``entity ⟕ bridge ⟕ account(dummy = 0)``, without shuffling the account table:

    * each (department row, real account) pair: accounts stream past the department map;
    * a NULL account for each department row no real account reaches;
    * a NULL account for each entity without any department row.
    """
    acc = real_accounts(catalog, spec)
    n = len(spec.account_keys)
    bkeys = [f"b_key{i}" for i in range(n)]
    inner = acc.join(departments, _key_match(acc, departments, n))
    matched = inner.select(*bkeys).distinct()
    cond = None
    for k in bkeys:
        c = departments[k] == matched[k]
        cond = c if cond is None else cond & c
    none = F.lit(None).cast(acc.schema["account_id"].dataType).alias("account_id")
    lonely = departments.join(matched, cond, "left_anti").select("entity_id", none)
    covered = departments.select("entity_id").distinct()
    bare = entity_base.select("entity_id").join(covered, "entity_id", "left_anti").select("entity_id", none)
    rows = inner.select("entity_id", "account_id").unionByName(lonely).unionByName(bare)
    return rows.join(entity_base, "entity_id").select("entity_id", "entity_name", "account_id")


def department_map(catalog: Catalog, spec: SpineSpec, allow: tuple[int, ...] | None) -> DataFrame:
    """(b_key0.., entity_id): the bridge rows of the allow-listed entities (a small dimension)."""
    ent = entities(catalog, spec, allow).select("entity_id")
    br = bridge(catalog, spec)
    return br.join(ent, br.b_entity == ent.entity_id).drop("b_entity")


def _key_match(acc: DataFrame, departments: DataFrame, n: int):
    cond = None
    for i in range(n):
        c = acc[f"a_key{i}"] == departments[f"b_key{i}"]
        cond = c if cond is None else cond & c
    return cond


def account_map(catalog: Catalog, spec: SpineSpec, departments: DataFrame) -> DataFrame:
    """(account_id, entity_id) for every real account of an allow-listed entity.

    The inner part of the spine: a repeated bridge row repeats the account, as in the chain.
    The department map is a small dimension: Spark broadcasts it by its size in bytes, and the
    large account table streams past it.
    """
    acc = real_accounts(catalog, spec)
    found = acc.join(departments, _key_match(acc, departments, len(spec.account_keys))).select("account_id", "entity_id")
    # Where no two bridge rows share the keys, the map has at most the accounts' rows; Spark's estimate of a
    # join is the product of its sides, so the bound is given as a hint.
    unique = spec.bridge_distinct and spec.bridge_entity in spec.bridge_keys
    if unique and 0 <= estimated_bytes(acc) <= broadcast_limit(catalog.spark):
        return F.broadcast(found)
    return found
