"""DuckDB oracle SQL for every fixture query.

Written deliberately in the *per-metric* shape of the original job – one left-join chain
``college ⟕ department ⟕ account ⟕ fact`` with ``GROUP BY college`` per metric, then
left merges – so that it is an independent check of the long-form Spark plan.

DuckDB specifics: ``COUNT``/``SUM`` are cast to BIGINT (``SUM`` is HUGEINT), ``row_number``
to BIGINT, and pair keys are built with ``||`` (DuckDB ``concat`` skips NULLs).
"""

from __future__ import annotations

from functools import partial

# Fixed values, stated here again so that an error in the engine's own layout shows as a mismatch.
ALLOW = tuple(range(1, 24))
CURRENT_REGION = 1
MODULES = ("teach", "engage", "assess", "track", "analyse", "remediate")
METRIC_LAYOUT = (
    ("metric_attendance", "teach", "attendance_count"),
    ("metric_hook_search", "teach", "hook_search_count"),
    ("metric_teach_studio", "teach", "teach_studio_count"),
    ("metric_live_assignment", "engage", "live_assignment_count"),
    ("metric_live_survey", "engage", "survey_count"),
    ("metric_notifications", "engage", "notify_count"),
    ("metric_live_class", "engage", "live_class_count"),
    ("metric_case_study", "engage", "case_study_count"),
    ("metric_projects", "engage", "projects_count"),
    ("metric_arena", "engage", "arena_count"),
    ("metric_gocode", "engage", "gocode_count"),
    ("metric_objective", "assess", "objective_count"),
    ("metric_subjective", "assess", "subjective_count"),
    ("metric_coding", "assess", "coding_count"),
    ("metric_assignment", "assess", "assignment_count"),
    ("metric_regular_feedback", "track", "regular_feedback_count"),
    ("metric_semester_feedback", "track", "semester_feedback_count"),
    ("metric_unit_feedback", "track", "unit_feedback_count"),
    ("metric_analyse", "analyse", "total_analyse"),
    ("metric_remediate", "remediate", "remediate_count"),
)

_ALLOW = "(" + ", ".join(str(i) for i in ALLOW) + ")"
_EV_HI = "TIMESTAMP '2024-01-16 08:00:00'"
_EV_LO = f"({_EV_HI} - INTERVAL 1 DAY)"
_ORD_HI = "TIMESTAMP '1998-07-01 08:00:00'"
_ORD_LO = f"({_ORD_HI} - INTERVAL 30 DAY)"

_DIMS = """college AS (SELECT n_nationkey AS id, n_name AS college_name FROM nation),
cuddn AS (SELECT DISTINCT c_nationkey AS college_id, c_mktsegment AS segment FROM customer),
can AS (SELECT c_custkey AS id, c_nationkey AS dept_nation, c_mktsegment AS dept_segment,
               CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS dummy FROM customer)"""

_CAN_ON = "can.dept_nation = cuddn.college_id AND can.dept_segment = cuddn.segment"


# Backfill: run k is the daily report moved k days back (window ends shifted by k days).
BACKFILL_RUNS = 7
_RUNS_CTE = f"runs AS (SELECT CAST(range AS INTEGER) AS k FROM range({BACKFILL_RUNS}))"
_SHIFT = " - to_days(r.k)"


def _statement(count: str, alias: str, fact_joins: str, *, dummy_in_where: bool = False,
               runs: bool = False) -> str:
    can_on = _CAN_ON if dummy_in_where else _CAN_ON + " AND can.dummy = 0"
    where = ("can.dummy = 0 AND " if dummy_in_where else "") + f"c.id IN {_ALLOW}"
    run_col, run_join, run_key = ("r.k, ", "\nCROSS JOIN runs r", "r.k, ") if runs else ("", "", "")
    return f"""SELECT {run_col}c.id AS college_id, c.college_name, {count} AS {alias}
FROM college c{run_join}
LEFT JOIN cuddn ON cuddn.college_id = c.id
LEFT JOIN can ON {can_on}
{fact_joins}
WHERE {where}
GROUP BY {run_key}c.id, c.college_name"""


def _bounds(hi: str, lookback: str, runs: bool) -> tuple[str, str]:
    end = f"({hi}{_SHIFT})" if runs else hi
    return f"({end} - {lookback})", end


def _event(kind_pred: str | None, runs: bool = False) -> str:
    extra = f" AND {kind_pred}" if kind_pred else ""
    lo, hi = _bounds(_EV_HI, "INTERVAL 1 DAY", runs)
    return (f"LEFT JOIN events e ON e.user_id = can.id{extra} AND e.ts IS NOT NULL "
            f"AND e.ts BETWEEN {lo} AND {hi}")


def _order(pred: str | None, runs: bool = False) -> str:
    extra = f" AND {pred}" if pred else ""
    lo, hi = _bounds(_ORD_HI, "INTERVAL 30 DAY", runs)
    return (f"LEFT JOIN orders o ON o.o_custkey = can.id{extra} AND o.o_orderdate IS NOT NULL "
            f"AND o.o_orderdate BETWEEN {lo} AND {hi}")


_FLAG = "(CASE o.o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 END)"
_CD = "CAST(COUNT(DISTINCT {}) AS BIGINT)"


def _metric_statements(runs: bool = False) -> dict[str, str]:
    ev = _CD.format("e.event_id")
    od = _CD.format("o.o_orderkey")
    ship_lo, ship_hi = _bounds(_ORD_HI, "INTERVAL 30 DAY", runs)
    stmt = partial(_statement, runs=runs)
    ev_join = partial(_event, runs=runs)
    od_join = partial(_order, runs=runs)
    s = {
        "metric_attendance": stmt(ev, "attendance_count", ev_join("e.event_type = 'view'")),
        "metric_hook_search": stmt(
            _CD.format("l.l_orderkey * 10 + l.l_linenumber"), "hook_search_count",
            "LEFT JOIN orders hdr ON hdr.o_custkey = can.id\n"
            f"LEFT JOIN lineitem l ON l.l_orderkey = hdr.o_orderkey AND l.l_shipdate BETWEEN {ship_lo} AND {ship_hi}",
            dummy_in_where=True),
        "metric_teach_studio": stmt(ev, "teach_studio_count", ev_join("e.event_type = 'click'"),
                                          dummy_in_where=True),
        "metric_live_assignment": stmt(ev, "live_assignment_count", ev_join("e.event_type = 'purchase'")),
        "metric_live_survey": stmt(ev, "survey_count", ev_join("e.event_type = 'signup'")),
        "metric_notifications": stmt(ev, "notify_count", ev_join("e.event_type = 'error'")),
        "metric_live_class": stmt(od, "live_class_count", od_join("o.o_orderpriority = '1-URGENT'")),
        "metric_case_study": stmt(od, "case_study_count", od_join("o.o_orderpriority = '2-HIGH'")),
        "metric_projects": stmt(od, "projects_count", od_join("o.o_orderpriority = '3-MEDIUM'")),
        "metric_arena": stmt(od, "arena_count", od_join("o.o_orderpriority = '4-NOT SPECIFIED'")),
        "metric_gocode": stmt(_CD.format("json_extract_string(e.props, '$.k')"), "gocode_count", ev_join(None)),
        "metric_objective": stmt(od, "objective_count", od_join(None)),
        "metric_subjective": stmt(od, "subjective_count", od_join(f"{_FLAG} = 0")),
        "metric_coding": stmt(od, "coding_count", od_join("o.o_orderpriority = '5-LOW'")),
        "metric_assignment": stmt(od, "assignment_count", od_join(f"{_FLAG} = 1")),
        "metric_regular_feedback": stmt(ev, "regular_feedback_count", ev_join("e.value < 20")),
        "metric_semester_feedback": stmt(ev, "semester_feedback_count", ev_join("e.value BETWEEN 20 AND 80")),
        "metric_unit_feedback": stmt(ev, "unit_feedback_count", ev_join("e.value > 80")),
        "metric_analyse": f"""SELECT {"r.k, " if runs else ""}c.id AS college_id, c.college_name,
       CAST(0 AS BIGINT) AS total_analyse
FROM college c{" CROSS JOIN runs r" if runs else ""}
WHERE c.id IN {_ALLOW}
GROUP BY {"r.k, " if runs else ""}c.id, c.college_name""",
        "metric_remediate": stmt(
            "CAST(COUNT(CAST(o.o_orderkey AS VARCHAR) || CAST(p.l_linenumber AS VARCHAR)) AS BIGINT)",
            "remediate_count",
            od_join("o.o_orderstatus = 'F'") + "\nLEFT JOIN lineitem p ON p.l_orderkey = o.o_orderkey"),
    }
    return s


_STATEMENTS = _metric_statements()
_BACKFILL_STATEMENTS = _metric_statements(runs=True)
_COLUMN = {key: col for key, _, col in METRIC_LAYOUT}


def _with(ctes: dict[str, str], body: str) -> str:
    parts = [_DIMS] + [f"{name} AS (\n{sql}\n)" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _merged(keys: list[str]) -> tuple[dict[str, str], str, list[str]]:
    """CTEs, FROM clause and coalesced columns of a left merge of metric statements."""
    ctes = {f"m{i}": _STATEMENTS[k] for i, k in enumerate(keys)}
    frm = "FROM m0"
    for i in range(1, len(keys)):
        frm += (f"\nLEFT JOIN m{i} ON m{i}.college_id = m0.college_id "
                f"AND m{i}.college_name IS NOT DISTINCT FROM m0.college_name")
    cols = [f"COALESCE(m{i}.{_COLUMN[k]}, 0) AS {_COLUMN[k]}" for i, k in enumerate(keys)]
    return ctes, frm, cols


def _module_keys(module: str) -> list[str]:
    return [k for k, mod, _ in METRIC_LAYOUT if mod == module]


def _module(module: str) -> str:
    ctes, frm, cols = _merged(_module_keys(module))
    return _with(ctes, "SELECT m0.college_id, COALESCE(m0.college_name, '0') AS college_name, "
                       + ", ".join(cols) + "\n" + frm)


def _detail_base() -> tuple[dict[str, str], str]:
    keys = [k for k, _, _ in METRIC_LAYOUT]
    ctes, frm, cols = _merged(keys)
    ctes["wide"] = ("SELECT m0.college_id, COALESCE(m0.college_name, '0') AS college_name, "
                    + ", ".join(cols) + "\n" + frm)
    return ctes, "wide"


def _detail() -> str:
    ctes, _ = _detail_base()
    cols = [col for _, _, col in METRIC_LAYOUT]
    usage = "CAST(" + " + ".join(cols) + " AS BIGINT) AS college_usage"
    body = (f"SELECT CAST(row_number() OVER (ORDER BY college_id) AS BIGINT) AS s_no, college_id, college_name, "
            f"{', '.join(cols)}, {usage}\nFROM wide")
    return _with(ctes, body)


def _ranked_ctes() -> dict[str, str]:
    ctes, _ = _detail_base()
    mods = []
    for mod in MODULES:
        cols = [_COLUMN[k] for k in _module_keys(mod)]
        mods.append(f'CAST({" + ".join(cols)} AS BIGINT) AS "{mod}"')
    ctes["modtot"] = "SELECT college_id, college_name, " + ", ".join(mods) + " FROM wide"
    quoted = [f'"{m}"' for m in MODULES]
    total = " + ".join(quoted)
    ctes["ranked"] = (f"SELECT CAST(row_number() OVER (ORDER BY ({total}) DESC, college_id ASC) AS BIGINT) AS s_no, "
                      f"college_id, college_name, {', '.join(quoted)}, CAST({total} AS BIGINT) AS total FROM modtot")
    return ctes


def _summary_ranked() -> str:
    return _with(_ranked_ctes(), "SELECT * FROM ranked")


def _summary() -> str:
    vals = [f'"{m}"' for m in MODULES] + ['"total"']
    body = ("SELECT CAST(s_no AS VARCHAR) AS s_no, CAST(college_id AS VARCHAR) AS college_id, college_name, "
            + ", ".join(vals) + " FROM ranked\nUNION ALL\n"
            + "SELECT 'Total' AS s_no, '-' AS college_id, 'Overall Total' AS college_name, "
            + ", ".join(f"CAST(COALESCE(SUM({v}), 0) AS BIGINT) AS {v}" for v in vals) + " FROM ranked")
    return _with(_ranked_ctes(), body)


def _spine() -> str:
    return _with({}, f"""SELECT c.id AS college_id, c.college_name, can.id AS account_id
FROM college c
LEFT JOIN cuddn ON cuddn.college_id = c.id
LEFT JOIN can ON {_CAN_ON} AND can.dummy = 0
WHERE c.id IN {_ALLOW}""")


def _window_audit() -> str:
    label = "'%d-%b-%Y (%I:%M %p)'"
    parts = []
    for source, table, col, lo, hi in (
            ("events", "events", "ts", _EV_LO, _EV_HI),
            ("orders", "orders", "o_orderdate", _ORD_LO, _ORD_HI),
            ("shipments", "lineitem", "l_shipdate", _ORD_LO, _ORD_HI)):
        parts.append(
            f"SELECT '{source}' AS source, '{table}' AS source_table, "
            f"CAST({lo} AS TIMESTAMP) AS window_start, CAST({hi} AS TIMESTAMP) AS window_end, "
            f"strftime({lo}, {label}) AS start_label, strftime({hi}, {label}) AS end_label, "
            f"strftime({hi}, '%d-%b-%Y') AS generated_on, "
            f"CAST(COUNT(*) AS BIGINT) AS rows_in_window FROM {table} WHERE {col} BETWEEN {lo} AND {hi}")
    return "\nUNION ALL\n".join(parts)


def _backfill_wide() -> dict[str, str]:
    keys = [k for k, _, _ in METRIC_LAYOUT]
    ctes = {f"m{i}": _BACKFILL_STATEMENTS[k] for i, k in enumerate(keys)}
    frm = "FROM m0"
    for i in range(1, len(keys)):
        frm += (f"\nLEFT JOIN m{i} ON m{i}.k = m0.k AND m{i}.college_id = m0.college_id "
                f"AND m{i}.college_name IS NOT DISTINCT FROM m0.college_name")
    cols = [_COLUMN[k] for k in keys]
    filled = [f"COALESCE(m{i}.{_COLUMN[k]}, 0) AS {_COLUMN[k]}" for i, k in enumerate(keys)]
    ctes["wide"] = ("SELECT m0.k, m0.college_id, COALESCE(m0.college_name, '0') AS college_name, "
                    + ", ".join(filled) + "\n" + frm)
    return ctes


_RUN_DAY = "strftime(CAST(DATE '2024-01-16' - k AS DATE), '%Y-%m-%d')"


def _with_runs(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join([_DIMS, _RUNS_CTE] + [f"{n} AS (\n{q}\n)" for n, q in ctes.items()]) + "\n" + body


def _backfill_detail() -> str:
    ctes = _backfill_wide()
    cols = [col for _, _, col in METRIC_LAYOUT]
    body = (f"SELECT {_RUN_DAY} AS report_date, "
            "CAST(row_number() OVER (PARTITION BY k ORDER BY college_id) AS BIGINT) AS s_no, "
            f"college_id, college_name, {', '.join(cols)}, "
            f"CAST({' + '.join(cols)} AS BIGINT) AS college_usage\nFROM wide")
    return _with_runs(ctes, body)


def _backfill_summary() -> str:
    ctes = _backfill_wide()
    mods = [f'CAST({" + ".join(_COLUMN[k] for k in _module_keys(mod))} AS BIGINT) AS "{mod}"' for mod in MODULES]
    ctes["modtot"] = "SELECT k, college_id, college_name, " + ", ".join(mods) + " FROM wide"
    quoted = [f'"{m}"' for m in MODULES]
    total = " + ".join(quoted)
    ctes["ranked"] = (f"SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY ({total}) DESC, college_id ASC) "
                      f"AS BIGINT) AS s_no, college_id, college_name, {', '.join(quoted)}, "
                      f"CAST({total} AS BIGINT) AS total FROM modtot")
    vals = quoted + ['"total"']
    body = (f"SELECT {_RUN_DAY} AS report_date, CAST(s_no AS VARCHAR) AS s_no, "
            "CAST(college_id AS VARCHAR) AS college_id, college_name, " + ", ".join(vals) + " FROM ranked\n"
            "UNION ALL\n"
            f"SELECT {_RUN_DAY} AS report_date, 'Total' AS s_no, '-' AS college_id, 'Overall Total' AS college_name, "
            + ", ".join(f"CAST(COALESCE(SUM({v}), 0) AS BIGINT) AS {v}" for v in vals)
            + " FROM runs LEFT JOIN ranked USING (k) GROUP BY k")
    return _with_runs(ctes, body)


def _entities_current_year() -> str:
    return f"""SELECT DISTINCT n.n_nationkey AS college_id, n.n_name AS college_name, r.r_name AS name
FROM customer cu
JOIN nation n ON n.n_nationkey = cu.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE r.r_regionkey = {CURRENT_REGION}"""


def oracle_sql() -> dict[str, str]:
    out = {"spine_active_accounts": _spine(), "report_window": _window_audit()}
    for key, sql in _STATEMENTS.items():
        out[key] = _with({}, sql)
    for mod in MODULES:
        out[f"module_{mod}"] = _module(mod)
    out["report_detail"] = _detail()
    out["report_summary_ranked"] = _summary_ranked()
    out["report_summary"] = _summary()
    out["entities_current_year"] = _entities_current_year()
    out["report_backfill"] = _backfill_detail()
    out["report_backfill_summary"] = _backfill_summary()
    out["report_backfill_merged"] = out["report_backfill"]  # the same numbers from day states
    return out
