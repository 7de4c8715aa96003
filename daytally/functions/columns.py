"""Small column helpers shared by the report builders.

They return SQL expression text: a wide projection is then parsed once by Spark instead of
being assembled from many column objects one call at a time.
"""

from __future__ import annotations


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def zero(col: str) -> str:
    return f"coalesce({q(col)}, CAST(0 AS BIGINT))"


def row_sum(columns: list[str]) -> str:
    """Row-wise sum where a missing cell counts as 0 (the report's fill rule)."""
    if not columns:
        return "CAST(0 AS BIGINT)"
    return "CAST(" + " + ".join(zero(c) for c in columns) + " AS BIGINT)"


def zero_filled(columns: list[str]) -> list[str]:
    return [f"CAST({zero(c)} AS BIGINT) AS {q(c)}" for c in columns]
