"""Registry of bound queries and their DuckDB oracle SQL.

``@bound(name, sql)`` registers a ``(spark, sf_dir) -> DataFrame`` callable
together with the ANSI SQL that computes the same result over the driver's
pre-registered views. ``sql=None`` marks operators checked by row count and
pytest only (sources, sinks, streaming).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def bound(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # importing the binding modules fills the registry
    from ledgerlens.plans import (  # noqa: F401
        bind_quality, bind_scalars, bind_dedup, bind_aggregates, bind_lookup,
        bind_anomaly, bind_audit, bind_io,
    )
