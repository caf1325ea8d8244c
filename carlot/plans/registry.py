"""All named queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carlot.plans import (
    cleaning_queries,
    field_queries,
    hierarchy_queries,
    image_queries,
    price_queries,
    score_queries,
    source_queries,
)
from carlot.plans.fixtures import Views

_MODULES = [
    field_queries, cleaning_queries, hierarchy_queries, price_queries, image_queries, score_queries,
    source_queries,
]


def _bind(build: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Views(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for m in _MODULES for name, build in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
