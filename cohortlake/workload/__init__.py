"""The library's operators as queries over the driver tables, with SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "cohort_queries",
    "profile_queries",
    "text_queries",
    "check_queries",
    "consume_queries",
    "release_queries",
    "source_queries",
    "typed_queries",
)


def _modules():
    return [import_module(f"{__name__}.{name}") for name in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for module in _modules() for k, v in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: v for module in _modules() for k, v in module.ORACLE.items()}
