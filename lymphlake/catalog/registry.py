"""Where queries are registered, each with its DuckDB SQL if it has one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import functions as F

from lymphlake.plans.views import ctes

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(*views: str, sql: str | None = None, ctes_more: str = "", rounded: tuple[str, ...] = (), digits: int = 9) -> Callable:
    """Register a query under its function's name; ``sql`` may read the named views.

    Columns of ``rounded`` are sums of doubles, whose last bits depend on the
    order of adding: both sides give them to ``digits`` digits.
    """

    def add(f: Callable) -> Callable:
        run = f
        if rounded:
            run = wraps(f)(lambda spark, d: f(spark, d).withColumns({c: F.round(c, digits) for c in rounded}))
        QUERIES[f.__name__] = run
        if sql is not None:
            heads = [c for c in (ctes(*views) if views else "", ctes_more.strip()) if c]
            body = f"SELECT * REPLACE ({', '.join(f'round(\"{c}\", {digits}) AS \"{c}\"' for c in rounded)}) FROM ({sql.strip()})" if rounded else sql.strip()
            ORACLES[f.__name__] = (f"WITH RECURSIVE {','.join(heads)}\n" if heads else "") + body
        return f

    return add
