"""Register of queries: a function of (session, folder), and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyline.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under its key."""

    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(pin_utc(spark), folder)

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add
