"""All queries over the reference's operators and the SQL they are held against."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from loomspan.plans.registry import Query

FAMILIES = ["relational", "aggregation", "windowing", "demand", "market", "texts", "streams"]
FLAGSHIP = "d_flow_price_change"


def _registries():
    return [import_module(f"loomspan.plans.{name}").Q for name in FAMILIES]


def queries() -> dict[str, Query]:
    return {name: fn for q in _registries() for name, fn in q.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for q in _registries() for name, sql in q.sql.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()[FLAGSHIP](spark, sf_dir)
