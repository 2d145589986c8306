"""Expense fact."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import as_ts
from comptoir.functions.records import clean_false, m2o_name, parse_dt
from comptoir.operators.incremental import backfill
from comptoir.operators.merge import purge_from, reload_parts, upsert
from comptoir.schemas import EXPENSE_RELATIONS, QTY
from comptoir.sources.scans import with_payload
from comptoir.sources.slices import not_before


def fct_expense(expenses: DataFrame, as_of: datetime | str) -> DataFrame:
    """Typed expenses; the employee is kept by name and in the payload."""
    return with_payload(expenses, relations=EXPENSE_RELATIONS).select(
        F.col("id").alias("expense_id"),
        clean_false("date").try_cast("date").alias("expense_date"),
        m2o_name("employee_id").alias("employee_name"),
        F.coalesce("total_amount", F.lit(0.0)).cast(QTY).alias("total_amount"),
        F.col("state").alias("status"),
        "payload",
        parse_dt("write_date").alias("write_ts"),
        parse_dt("create_date").alias("create_ts"),
        as_ts(as_of).alias("updated_at"),
    )


def load_expenses(target: DataFrame, expenses: DataFrame, as_of: datetime | str, since_ts: datetime | str) -> DataFrame:
    """Incremental load of expenses written after a time."""
    new = fct_expense(expenses.filter(not_before("write_date", since_ts)), as_of).filter(F.col("write_ts") > as_ts(since_ts))
    return upsert(target, new, ["expense_id"])


def load_expense_status(target: DataFrame, expenses: DataFrame, as_of: datetime | str, since_ts: datetime | str) -> DataFrame:
    """As ``load_expenses``, but a known expense only takes a new status and payload."""
    new = fct_expense(expenses.filter(not_before("write_date", since_ts)), as_of).filter(F.col("write_ts") > as_ts(since_ts))
    return upsert(target, new, ["expense_id"], update_cols=["status", "payload", "updated_at"])


def reload_expenses(
    target: DataFrame, expenses: DataFrame, as_of: datetime | str, from_day: date | str, to_day: date | str,
    purge: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Full reload of a day range, optionally after a purge; also the rows per day."""
    rows, per_day = backfill(fct_expense(expenses, as_of), "expense_date", from_day, to_day)
    if purge:
        target = purge_from(target, "expense_date", from_day)
    return upsert(target, rows, ["expense_id"]), per_day


def store_expenses(expenses: DataFrame, path: str, from_day: date | str, to_day: date | str | None = None) -> list[str]:
    """Expenses by day: a purge from ``from_day`` on and the reload of the same days in one; undated rows stay out."""
    dated = expenses.filter(F.col("expense_date").isNotNull())
    return reload_parts(dated.sparkSession, path, dated, "expense_date", from_day, to_day)
