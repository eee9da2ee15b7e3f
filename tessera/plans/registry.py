from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}

FAMILIES = ("relational", "text", "cooc", "index", "graph", "linear", "events")


def register(name: str, sql: str | None = None):
    """Register a plan under ``name``; ``sql`` is its DuckDB oracle (None: rows-only check)."""
    def deco(fn: Plan) -> Plan:
        if name in REGISTRY:
            raise KeyError(f"duplicate query key {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for fam in FAMILIES:
        importlib.import_module(f"tessera.plans.{fam}")
