"""Registered queries: operators bound to the given tables.

A query is a function of (session, data folder). Its SQL, where there is one,
is written independently of the operator: it states the expected
result on the same tables, over all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ["prices", "texts", "merges", "ingest", "fields", "profiles", "similarity", "matrices", "streams"]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def registry() -> dict[str, Query]:
    """All queries, in the order of the modules."""
    found: dict[str, Query] = {}
    for module in MODULES:
        found.update(import_module(f"tabloom.plans.{module}").QUERIES)
    return found
