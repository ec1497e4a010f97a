"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.standins import StandIns
from .views import VIEWS

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def six(expression: str) -> str:
    """Six decimals in SQL. The small shift keeps exact halves from falling either way."""
    return f"floor(cast({expression} as double) * 1e6 + 0.501) / 1e6"


def tidy(df: DataFrame) -> DataFrame:
    """Floating columns to six decimals, as ``six`` does, so that summation order does not show."""

    def column(name: str, kind: str) -> str:
        if kind in ("double", "float"):
            return f"floor(cast(`{name}` as double) * 1e6D + 0.501D) / 1e6D as `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[column(n, k) for n, k in df.dtypes])


def with_views(sql: str) -> str:
    """Put the views a statement uses in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\w+", text)) & VIEWS.keys() - needed:
            needed.add(name)
            visit(VIEWS[name])

    visit(sql)
    parts = [f"{name} as (\n{text.strip()}\n)" for name, text in VIEWS.items() if name in needed]
    return f"with {', '.join(parts)}\n{sql.strip()}" if parts else sql.strip()


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a function of the stand-ins under a name; ``doubles`` names its floating columns."""

    def register(build: Callable[[StandIns], DataFrame]):
        def run(spark, folder):
            return tidy(build(StandIns(spark, folder)))

        run.__name__ = run.__qualname__ = name
        run.__doc__ = build.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            rounded = ", ".join(f"{six(c)} as {c}" for c in doubles.split())
            body = f"select * replace ({rounded}) from (\n{sql.strip()}\n) result" if rounded else sql
            ORACLES[name] = with_views(body)
        return build

    return register
