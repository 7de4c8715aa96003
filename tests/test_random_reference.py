"""Randomized check of the production registry against brute-force SQL.

Seeded random tables in the original schema (NULL names and flags, repeated ids, repeated
bridge rows, values exactly on the window bounds, DATE columns) are evaluated twice: by the
long-form engine, and by DuckDB running one plain left-join statement per metric generated
from the same declarations (the original job's shape).
"""

from __future__ import annotations

import random
from datetime import date, timedelta

import duckdb
import pyarrow as pa
import pytest

from daytally import Catalog, DailyReport, ReportWindow
from daytally.operators.specs import CONSTANT, DISTINCT, PAIRS
from daytally.plans import reference_schema

from .test_edge_cases import SCHEMAS

WINDOW = ReportWindow.closing_on(date(2024, 1, 2))
ALLOW = (1, 2, 3, 4, 5, 6, 99)
ARROW = {"INT": pa.int32(), "BIGINT": pa.int64(), "STRING": pa.string(), "DATE": pa.date32(),
         "TIMESTAMP_NTZ": pa.timestamp("us")}


def _columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(",")]


def _tables(seed: int, unique_ids: bool, repeat_bridge: bool) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    lo, hi = WINDOW.start, WINDOW.end

    def ts():
        r = rnd.random()
        if r < 0.08:
            return None
        if r < 0.35:
            return rnd.choice([lo, hi, lo - timedelta(microseconds=1), hi + timedelta(microseconds=1)])
        return lo - timedelta(hours=12) + timedelta(seconds=rnd.randrange(48 * 3600))

    def day():
        return rnd.choice([date(2024, 1, 1), date(2024, 1, 2), date(2023, 12, 31), None])

    def flag():
        return rnd.choice([0, 0, 1, 1, None])

    colleges = [(i, None if rnd.random() < 0.15 else f"C{i}") for i in range(1, 8)]
    depts = [(10 + i, rnd.randint(1, 8)) for i in range(12)]
    if repeat_bridge:
        depts += rnd.sample(depts, 2)  # repeated bridge rows: accounts reach an entity twice
    dept_ids = [d for d, _ in depts] + [99]
    accounts = [(100 + i, rnd.choice(dept_ids), rnd.choice([0, 0, 0, 1, None])) for i in range(30)]
    acc_ids = [a for a, _, _ in accounts] + [None, 999]

    def ids(n=25):
        return rnd.choice(list(range(1, n)) + [None])

    out: dict[str, list[tuple]] = {
        "college": colleges,
        "college_university_degree_department_new": depts,
        "college_account_new": accounts,
    }
    headers = [(rnd.randint(1, 12), rnd.choice(acc_ids)) for _ in range(15)]
    out["college_account_co_pilot_search"] = headers
    for name, ddl in SCHEMAS.items():
        if name in out:
            continue
        cols = _columns(ddl)
        rows = []
        n = rnd.randint(40, 120)
        pk = rnd.sample(range(1, 10 * n), n)  # a primary key: unique ids
        for r in range(n):
            row = []
            for col, typ in cols:
                if col == "id" and unique_ids and name != "questionnaire_remedial_path":
                    row.append(pk[r])
                elif col in ("college_account_id", "faculty_id"):
                    row.append(rnd.choice(acc_ids))
                elif col == "college_account_co_pilot_search_id":
                    row.append(rnd.choice([h for h, _ in headers] + [None]))
                elif col == "questionnaire_id":
                    row.append(ids())
                elif col in ("is_assignment", "remedial_path"):
                    row.append(flag())
                elif col == "question_id":
                    row.append(ids(6))
                elif typ == "DATE":
                    row.append(day())
                elif typ == "TIMESTAMP_NTZ":
                    row.append(ts())
                else:
                    row.append(ids())
            rows.append(tuple(row))
        out[name] = rows
    return out


def _oracle_statements(spec) -> dict[str, str]:
    lo, hi = (f"TIMESTAMP '{t.strftime('%Y-%m-%d %H:%M:%S.%f')}'" for t in (WINDOW.start, WINDOW.end))
    allow = "(" + ", ".join(map(str, ALLOW)) + ")"
    out = {}
    for m in spec.metrics:
        where_form = m.account_filter == "where"
        head = (f"SELECT c.id AS college_id, c.college_name, {{count}} AS {m.column}\n"
                "FROM college c\n"
                "LEFT JOIN college_university_degree_department_new d ON d.college_id = c.id\n"
                "LEFT JOIN college_account_new a ON a.college_university_degree_department_id = d.id"
                + ("" if where_form else " AND a.dummy = 0") + "\n")
        tail = f"WHERE {'a.dummy = 0 AND ' if where_form else ''}c.id IN {allow}\nGROUP BY c.id, c.college_name"
        if m.measure == CONSTANT:
            out[m.key] = (f"SELECT c.id AS college_id, c.college_name, {m.constant} AS {m.column} FROM college c "
                          f"WHERE c.id IN {allow}")
            continue
        src = spec.source_by_name[m.source]
        extra = f" AND ({m.where})" if m.where else ""
        if m.measure == DISTINCT and src.header is None:
            joins = (f"LEFT JOIN {src.table} f ON f.{src.account} = a.id{extra} "
                     f"AND f.{src.time} BETWEEN {lo} AND {hi}\n")
            count = f"COUNT(DISTINCT f.{m.value})"
        elif m.measure == DISTINCT:
            h = src.header
            joins = (f"LEFT JOIN {h.table} h ON h.{h.account} = a.id\n"
                     f"LEFT JOIN {src.table} f ON f.{h.link} = h.{h.id}{extra} "
                     f"AND f.{src.time} BETWEEN {lo} AND {hi}\n")
            count = f"COUNT(DISTINCT f.{m.value})"
        else:
            assert m.measure == PAIRS
            ch = m.child
            joins = (f"LEFT JOIN {src.table} p ON p.{src.account} = a.id{extra} "
                     f"AND p.{src.time} BETWEEN {lo} AND {hi}\n"
                     f"LEFT JOIN {ch.table} ch ON ch.{ch.link} = p.{m.value}\n")
            count = f"COUNT(CAST(p.{m.value} AS VARCHAR) || CAST(ch.{ch.id} AS VARCHAR))"
        out[m.key] = head.format(count=count) + joins + tail
    return out


@pytest.mark.parametrize("seed,unique_ids,repeat_bridge,doubled,bound", [
    (1, True, False, False, 2_000_000), (2, True, False, True, 2_000_000),
    (3, True, True, True, 0),
    (4, False, True, False, 0), (5, False, False, True, 2_000_000),
])
def test_engine_equals_per_metric_sql(spark, seed, unique_ids, repeat_bridge, doubled, bound):
    """Also with every fact row present twice, as after a repeated export: ids are still counted once."""
    tables = _tables(seed, unique_ids=unique_ids, repeat_bridge=repeat_bridge)
    if doubled:
        dimensions = ("college", "college_university_degree_department_new", "college_account_new",
                      "college_account_co_pilot_search")
        tables = {name: rows if name in dimensions else rows + rows for name, rows in tables.items()}
    con = duckdb.connect()
    frames = {}
    for name, ddl in SCHEMAS.items():
        cols = _columns(ddl)
        rows = tables.get(name, [])
        arrow = pa.table({c: pa.array([r[i] for r in rows], type=ARROW[t]) for i, (c, t) in enumerate(cols)})
        con.register(name, arrow)
        frames[name] = spark.createDataFrame(rows, ddl)
    spec = reference_schema.report_spec(WINDOW, allow=ALLOW, key_filter_above=bound)
    report = DailyReport(Catalog.in_memory(spark, frames), spec)

    expected: dict[str, dict[int, int]] = {}
    for key, sql in _oracle_statements(spec).items():
        expected[key] = {int(r[0]): int(r[2]) for r in con.execute(sql).fetchall()}

    detail = {r["college_id"]: r for r in report.detail().collect()}
    assert set(detail) == set(expected["metric_attendance"])  # the ON-form base keeps every college
    for m in spec.metrics:
        for college, row in detail.items():
            assert row[m.column] == expected[m.key].get(college, 0), (seed, m.key, college)
    for m in spec.metrics:
        if m.account_filter == "where":  # the raw statement drops colleges without a real account
            got = {r["college_id"]: r[m.column] for r in report.metric(m.key).collect()}
            assert got == expected[m.key], (seed, m.key)


@pytest.mark.parametrize("seed,repeat_bridge", [(6, True), (7, False)])
def test_spine_equals_the_left_chain(spark, seed, repeat_bridge):
    tables = _tables(seed, unique_ids=True, repeat_bridge=repeat_bridge)
    con = duckdb.connect()
    frames = {}
    for name in ("college", "college_university_degree_department_new", "college_account_new"):
        cols = _columns(SCHEMAS[name])
        rows = tables[name]
        con.register(name, pa.table({c: pa.array([r[i] for r in rows], type=ARROW[t]) for i, (c, t) in enumerate(cols)}))
        frames[name] = spark.createDataFrame(rows, SCHEMAS[name])
    allow = "(" + ", ".join(map(str, ALLOW)) + ")"
    want = con.execute(f"""SELECT c.id, c.college_name, a.id FROM college c
        LEFT JOIN college_university_degree_department_new d ON d.college_id = c.id
        LEFT JOIN college_account_new a ON a.college_university_degree_department_id = d.id AND a.dummy = 0
        WHERE c.id IN {allow}""").fetchall()
    report = DailyReport(Catalog.in_memory(spark, frames), reference_schema.report_spec(WINDOW, allow=ALLOW))
    got = [tuple(r) for r in report.spine_active_accounts().collect()]
    key = lambda r: (r[0], r[2] is None, r[2] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
