"""``@query(name, sql)`` keeps a query next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def r(expr: str, digits: int = 5) -> str:
    """SQL: rounded double without negative zero."""
    return f"(ROUND(CAST({expr} AS DOUBLE), {digits}) + 0.0e0)"


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 5) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in cols})


# Frequency -> (length in months, first month).
_FREQ = {"MS": (1, 0), "YS": (12, 0), "AS-JUL": (12, 6), "QS-DEC": (3, 11), "2QS-OCT": (6, 9)}


def period_no(freq: str) -> str:
    length, first = _FREQ[freq]
    m = "(year * 12 + month - 1)"
    return f"({m} - ({m} - {first}) % {length})"


def month_date(no: str) -> str:
    return f"make_date(CAST({no} // 12 AS INT), CAST({no} % 12 + 1 AS INT), 1)"


def pstart(freq: str) -> str:
    return month_date(period_no(freq))
