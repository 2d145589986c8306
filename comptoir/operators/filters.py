"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import STATUS_OK, as_date

# fixed values: locations of the stock situation report
SITUATION_LOCATIONS = (
    "PARTNER | CUSTOMERS",
    "DEPOT | CENTRAL NEW | STOCK",
    "BOUTIQUE | B24 | STOCK",
    "BOUTIQUE | JUSTICE | STOCK",
    "BOUTIQUE | KINTAMBO | STOCK",
    "BOUTIQUE | METEO | STOCK",
    "BOUTIQUE | LUSHI | STOCK",
    "VIRTUAL | PRODUCTION",
    "PARTNER | VENDORS",
    "OTHER_INTERNAL | EMPLACEMENT TEMPORAIRE",
    "VIRTUAL | INVENTORY_ADJUSTMENT",
)


def on_day(df: DataFrame, col: str, day: date | str) -> DataFrame:
    return df.filter(F.col(col) == as_date(day))


def on_days(df: DataFrame, col: str, from_day: date | str, to_day: date | str) -> DataFrame:
    """Inclusive day range."""
    return df.filter(F.col(col).between(as_date(from_day), as_date(to_day)))


def locations_in(df: DataFrame, names: Sequence[str] = SITUATION_LOCATIONS, col: str = "name_norm") -> DataFrame:
    return df.filter(F.col(col).isin(*names))


def exclude_ids(df: DataFrame, ids: Sequence[int], col: str = "location_id") -> DataFrame:
    """Drop configured ids; an empty list drops nothing."""
    return df.filter(~F.col(col).isin(*ids)) if ids else df


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def rejected_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """How many rows ``drop_incomplete`` drops, and of how many."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~complete).alias("rejected_rows"),
    )


def current(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.filter(F.col(flag))


def only_exceptions(df: DataFrame, *status: str) -> DataFrame:
    """Rows where any status is not OK."""
    cond = F.lit(False)
    for c in status:
        cond = cond | (F.col(c) != STATUS_OK)
    return df.filter(cond)


def nonzero(c: Column | str) -> Column:
    """Not zero, where a missing value is zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0)) != 0


def in_state(c: Column | str, state: str = "done") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("")) == state
