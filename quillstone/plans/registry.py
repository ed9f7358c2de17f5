"""Queries of the core operators for the driver, with their SQL."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.plans import catalog_queries, pipeline_queries, record_queries, text_queries

MODULES = (text_queries, record_queries, catalog_queries, pipeline_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for m in MODULES for n, f in vars(m).items() if inspect.isfunction(f) and f.__module__ == m.__name__ and n[0] != "_"}


def oracle_sql() -> dict[str, str]:
    return {n: s for m in MODULES for n, s in m.SQL.items()}
