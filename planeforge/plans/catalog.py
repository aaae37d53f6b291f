"""The list of queries and their SQL twins."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled_methods

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


def _needed(sql: str, seen: dict[str, None]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(CTES[name], seen)
            seen[name] = None


def with_ctes(sql: str) -> str:
    """Prefix a statement with the shared tables it mentions."""
    sql = sql.strip()
    seen: dict[str, None] = {}
    _needed(sql, seen)
    if not seen:
        return sql
    recursive = "RECURSIVE " if sql.upper().startswith("WITH RECURSIVE") else ""
    own = re.sub(r"^WITH (RECURSIVE )?", "", sql, flags=re.I) if re.match(r"WITH\b", sql, re.I) else None
    head = f"WITH {recursive}" + ", ".join(f"{n} AS ({CTES[n]})" for n in seen)
    return f"{head}, {own}" if own is not None else f"{head} {sql}"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        assert name not in QUERIES, name

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            compiled_methods(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn

    return register
