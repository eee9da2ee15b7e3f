"""Registered queries: each key maps to a plan ``(spark, sf_dir) -> DataFrame`` over the test
tables, and (where SQL can say it) to an independent DuckDB SQL answer."""

from tessera.plans.registry import REGISTRY, ORACLE, load_all  # noqa: F401
