"""Registry of queries and their SQL oracles, filled by the modules of this package."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``oracle`` may name the shared ``fx_`` views."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return register


def with_views(sql: str) -> str:
    """Prefix the text with the views it uses, and those they use in turn."""
    from terrahaz.queries.views import SQL_VIEWS

    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in SQL_VIEWS and name not in needed:
                visit(SQL_VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in needed)
    body = sql.strip()
    joiner = ",\n" if re.match(r"(?i)with\s", body) else "\n"
    if joiner == ",\n":
        body = re.sub(r"(?i)^with\s+", "", body)
    return f"WITH {ctes}{joiner}{body}"
