"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import Tables, oracle

QUERIES: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query on the tables; ``sql`` is its DuckDB twin."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = (fn, None if sql is None else oracle(sql))
        return fn

    return add


def portable(df: DataFrame) -> DataFrame:
    """Types that both engines hand over alike: decimals as doubles, dates and times as text."""
    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(QUERIES[name][0](Tables(spark, sf_dir)))
