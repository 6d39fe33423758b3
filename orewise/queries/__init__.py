"""Registered queries: each operator on inputs derived from the shared tables, with DuckDB SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Registers a function of Inputs as a query; uses names the shared CTEs of its SQL."""

    def add(f):
        from .inputs import Inputs, with_ctes

        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        QUERIES[name].__doc__ = f.__doc__
        if sql:
            SQL[name] = with_ctes(uses.split(), sql)
        return f

    return add


def load() -> None:
    from . import fits, joins, objects, pixels, sheets, sites, sources, studies, thermal, variants  # noqa: F401
