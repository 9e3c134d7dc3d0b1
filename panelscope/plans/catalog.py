"""Registered queries: one Spark plan per operator, each with its DuckDB oracle.

Each entry reads the driver's whole tables through :mod:`panelscope.sources.synth`
and applies one operator. Results are the operator's own, unrounded.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from panelscope.plans import oracle as O


@dataclass
class Query:
    name: str
    spark: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def oracle(self) -> str | None:
        return None if self.sql is None else O.with_ctes(O.as_select(self.sql))


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


# Import the query modules for their registration side effects.
from panelscope.plans import queries_core  # noqa: E402,F401
from panelscope.plans import queries_dynamics  # noqa: E402,F401
from panelscope.plans import queries_births  # noqa: E402,F401
from panelscope.plans import queries_extra  # noqa: E402,F401
from panelscope.plans import queries_compare  # noqa: E402,F401
