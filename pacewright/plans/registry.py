"""Registered queries: name -> (function of the session and the table folder, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a unique name, with the SQL that must give the same rows."""

    def register(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return register


#: Modules of this package that register queries.
MODULES = ("views", "checks", "joins", "aggregates", "windows", "sets", "texts", "nested", "analysis", "assembly", "survey", "documents", "projections", "printed", "identity", "orders", "listings", "readers", "notes")


def _load() -> None:
    for name in MODULES:
        import_module(f"pacewright.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
