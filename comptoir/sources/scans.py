"""Full and scoped reads, and projections that tolerate a varying source."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

# fixed values: columns that may hold the journal, best first
JOURNAL_COLUMNS = ("journal_id", "cash_journal_id", "account_journal_id", "payment_journal_id")


def read_dim(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole dimension from Parquet."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int = 16,
    **options: str,
) -> DataFrame:
    """Whole table over JDBC, read by ``partitions`` tasks split on a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower),
                 upperBound=str(upper), numPartitions=str(partitions), fetchsize="10000", **options)
        .load()
    )


def scan_in_scope(
    rows: DataFrame, locations: DataFrame, usages: Sequence[str], on: str = "location_id",
    positive: str | None = None,
) -> DataFrame:
    """Rows at locations of the given usages, optionally with a positive quantity."""
    wanted = locations.filter(F.col("usage").isin(*usages)).select(on)
    if positive:
        rows = rows.filter(F.col(positive) > 0)
    return rows.join(wanted, on, "left_semi")


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the source has; the others are logged."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        LOG.warning("columns missing from the source: %s", ", ".join(missing))
    return df.select(*[c for c in wanted if c in df.columns])


def first_available(
    df: DataFrame, candidates: Sequence[str] = JOURNAL_COLUMNS, forced: str | None = None
) -> Column:
    """The forced column if there is one, else the first candidate there is, else NULL."""
    for name in ([forced] if forced else []) + list(candidates):
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def record_json(columns: Sequence[str], relations: Sequence[str] = (), extra: Sequence[Column] = ()) -> Column:
    """A record as JSON. Relations, which are JSON text already, are set in as they
    are: neither quoted nor parsed again."""
    plain = [F.col(c) for c in columns if c not in relations]
    rest = F.to_json(F.struct(*plain, *extra), {"ignoreNullFields": "false"})
    nested = [
        F.concat(F.lit(f'"{c}":'), F.when(F.trim(c) != "", F.col(c)).otherwise("null"), F.lit(","))
        for c in relations
    ]
    return F.concat(F.lit("{"), *nested, F.substr(rest, F.lit(2))) if nested else rest


def with_payload(df: DataFrame, name: str = "payload", relations: Sequence[str] = ()) -> DataFrame:
    """Keep the whole record as JSON next to its typed columns."""
    return df.withColumn(name, record_json(df.columns, [c for c in relations if c in df.columns]))
