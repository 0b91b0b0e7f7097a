"""A registry that pairs each Spark query with an independent SQL text for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanweave.plans.adapters import LOANS_SQL, PANEL_SQL, SCORED_SQL, TIED_SQL, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SOURCES = {"loans": LOANS_SQL, "panel": PANEL_SQL, "scored": SCORED_SQL, "tied": TIED_SQL}


def query(name: str, sql: str | None = None, uses: str = "", ctes: str = ""):
    """Register ``function(tables) -> DataFrame`` with its SQL, if SQL can express it.

    ``uses`` names the derived source tables the SQL reads, ``ctes`` holds more steps.
    """

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, directory: function(Tables(spark, directory))
        if sql is not None:
            parts = [SOURCES[u] for u in uses.split()] + ([ctes] if ctes else [])
            ORACLES[name] = (f"with {', '.join(parts)}\n" if parts else "") + sql
        return function

    return register


def r6(column: str | Column, name: str | None = None) -> Column:
    """Rounded to six places, so that engines may differ in the last bits only."""
    c = F.col(column) if isinstance(column, str) else column
    rounded = F.round(c, 6)
    return rounded.alias(name or column) if name or isinstance(column, str) else rounded
