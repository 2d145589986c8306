"""Unions and unpivots."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.measures import SOURCE_SIDE, TARGET_SIDE, as_date

# fixed values
OPENING_TYPE, OPENING_SOURCE = "OPENING", "INITIAL"
MOVE_SOURCE, UNKNOWN_TYPE = "ODOO_MOVE", "INCONNU"


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def day_spine(spark: SparkSession, from_day: date | str, to_day: date | str, into: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(as_date(from_day), as_date(to_day), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias(into))


def month_spine(spark: SparkSession, from_day: date | str, to_day: date | str, into: str = "month") -> DataFrame:
    """First days of the months touched by the range."""
    first, last = F.trunc(as_date(from_day), "month"), F.trunc(as_date(to_day), "month")
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias(into))


def to_double_entry(moves: DataFrame, source: Mapping[str, Column], target: Mapping[str, Column]) -> DataFrame:
    """Two rows per move, one for each side, with that side's columns.

    The doubling is a narrow step: nothing is shuffled or read twice.
    """
    def side(name: str, cols: Mapping[str, Column]) -> Column:
        return F.struct(F.lit(name).alias("side"), *[c.alias(k) for k, c in cols.items()])

    kept = [c for c in moves.columns if c not in source]
    return moves.select(
        *kept, F.inline(F.array(side(SOURCE_SIDE, source), side(TARGET_SIDE, target)))
    )
