"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from suite.inputs import check_sql

QUERIES: dict[str, Callable] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name; without SQL only its rows are looked at."""

    def register(fn: Callable) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = check_sql(sql)
        return fn

    return register
