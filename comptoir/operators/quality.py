"""Reconciliation, coverage and freshness checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import as_date
from comptoir.operators.joins import reconcile
from comptoir.operators.sets import day_spine, month_spine

# fixed values: report families
REPORT_FAMILIES = (
    "Rapport_Encaissement", "Stock_Opening", "Stock_Exceptions", "Situation_Stock", "Vente_Detaillee"
)
FRESH, STALE, MISSING = "FRESH", "STALE", "MISSING"


def stock_situation(
    spine: DataFrame, prev: DataFrame, curr: DataFrame, moves: DataFrame, on: Sequence[str] = ("location_id",)
) -> DataFrame:
    """Earlier opening plus movement against the later opening, per location.

    The sides are one row per key: ``open_qty_prev``, ``open_qty_curr`` and
    ``in_qty, out_qty, net_movement``.
    """
    def zero(c: Column | str) -> Column:
        return F.coalesce(c, F.lit(0))

    closing = zero("open_qty_prev") + zero("net_movement")
    return reconcile(spine, on, prev, curr, moves).select(
        *spine.columns,
        zero("open_qty_prev").alias("open_qty_prev"),
        zero("in_qty").alias("in_qty"),
        zero(-F.col("out_qty")).alias("out_qty"),
        zero("net_movement").alias("net_movement"),
        closing.alias("closing_qty"),
        zero("open_qty_curr").alias("open_qty_curr"),
        (zero("open_qty_curr") - closing).alias("variance"),
    )


def missing_days(df: DataFrame, day_col: str, from_day: date | str, to_day: date | str) -> DataFrame:
    """Days of the range that hold no data."""
    held = df.select(F.col(day_col).cast("date").alias("day")).distinct()
    return day_spine(df.sparkSession, from_day, to_day).join(held, "day", "left_anti")


def missing_months(df: DataFrame, day_col: str, from_day: date | str, to_day: date | str) -> DataFrame:
    """Months of the range, by their first day, that hold no data."""
    held = df.select(F.trunc(F.col(day_col).cast("date"), "month").alias("month")).distinct()
    return month_spine(df.sparkSession, from_day, to_day).join(held, "month", "left_anti")


def negative_stock(df: DataFrame, qty: str = "qty") -> DataFrame:
    return df.filter(F.col(qty) < 0)


def report_status(
    outputs: DataFrame, as_of: date | str, families: Sequence[str] = REPORT_FAMILIES,
    family_col: str = "family", day_col: str = "report_day",
) -> DataFrame:
    """Per report family the newest day there is output for, and whether it is today's."""
    newest = outputs.groupBy(F.col(family_col).alias("family")).agg(F.max(F.col(day_col).cast("date")).alias("newest"))
    names = F.explode(F.array(*[F.lit(f) for f in families]))
    spine = outputs.sparkSession.range(1).select(names.alias("family"))
    status = (
        F.when(F.col("newest").isNull(), MISSING)
        .when(F.col("newest") == as_date(as_of), FRESH)
        .otherwise(STALE)
    )
    return spine.join(newest, "family", "left").withColumn("status", status)
