"""Report queries. Each takes a day range and computes all its days in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.measures import (
    age_days, as_date, fin_status, qty_status, movement_qty,
)
from comptoir.functions.names import shop_key, valid_barcode
from comptoir.functions.records import json_path
from comptoir.operators.aggregates import (
    CASH_METHOD, PAY_METHODS, age_bucket, by_bucket, movement_io, pay_by_method, sum_by,
)
from comptoir.operators.filters import SITUATION_LOCATIONS, current, locations_in, nonzero, on_days, only_exceptions
from comptoir.operators.joins import attach_order, join_day_shop, join_valid, left_dim, with_dims
from comptoir.operators.quality import stock_situation as situation
from comptoir.operators.sets import day_spine
from comptoir.operators.windows import numbered, sorted_report


def as_day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def period(from_day: date | str, to_day: date | str | None = None) -> tuple[date, date]:
    """One date means the month up to it; two are an inclusive range."""
    first = as_day(from_day)
    if to_day is None:
        return first.replace(day=1), first
    last = as_day(to_day)
    if last < first:
        raise ValueError("the period ends before it starts")
    return first, last


def sales_by_shop(payments: DataFrame, shops: DataFrame, methods: DataFrame, pay_methods: Mapping[str, str]) -> DataFrame:
    """Takings per shop and day, by payment method.

    Payments are summed per shop id, day and method id first, so what is joined
    to the names is small however many payments there are.
    """
    summed = payments.groupBy("config_id", "method_id", F.col("payment_day").alias("day")).agg(
        F.sum("amount").alias("amount")
    )
    named = left_dim(
        summed.join(shops.select(F.col("shop_id").alias("config_id"), F.col("name").alias("shop")), "config_id"),
        methods.select("method_id", F.col("name").alias("method_name")),
        "method_id",
    )
    return pay_by_method(named, ["shop", "day"], pay_methods, total="total_sales").withColumn(
        "shop_key", shop_key("shop")
    )


def expenses_by_shop(expenses: DataFrame, staff: DataFrame) -> DataFrame:
    """Expenses per shop and day, by who spent and where they worked that day."""
    spent = expenses.filter(nonzero("total_amount"))
    summed = spent.groupBy(F.col("expense_date").alias("day"), "employee_name").agg(
        F.sum("total_amount").alias("total_amount")
    )
    return sum_by(join_valid(summed, staff, "employee_name", "day"), ["day", "shop_key"], "total_amount", "expenses")


def daily_revenue(
    payments: DataFrame, shops: DataFrame, methods: DataFrame, expenses: DataFrame, staff: DataFrame,
    from_day: date | str, to_day: date | str | None = None,
    pay_methods: Mapping[str, str] = PAY_METHODS, cash: str = CASH_METHOD, renumber: bool = False,
) -> DataFrame:
    """Takings, expenses and amount to deposit per shop and day.

    The amount to deposit is cash less expenses, and missing when a shop took
    no cash. Rows are numbered per day, or through the period.
    """
    to_day = from_day if to_day is None else to_day
    sales = sales_by_shop(on_days(payments, "payment_day", from_day, to_day), shops, methods, pay_methods)
    spent = expenses_by_shop(on_days(expenses, "expense_date", from_day, to_day), staff)
    zero = F.lit(0)
    rows = join_day_shop(sales, spent).select(
        "shop", "day", "total_sales",
        *[F.coalesce(m, zero).alias(m) for m in pay_methods],
        F.coalesce("expenses", zero).alias("expenses"),
        (F.col(cash) - F.coalesce("expenses", zero)).alias("to_deposit"),
    )
    return numbered(rows, ["shop"], per="day", period=renumber)


def daily_revenue_period(*frames: DataFrame, from_day: date | str, to_day: date | str | None = None, **kw) -> DataFrame:
    """Month to date, or a given range, numbered through."""
    first, last = period(from_day, to_day)
    return daily_revenue(*frames, from_day=first, to_day=last, renumber=True, **kw)


def daily_revenue_last(*frames: DataFrame, as_of: date | str, days: int = 3, **kw) -> DataFrame:
    """The last complete days before ``as_of``."""
    today = as_day(as_of)
    return daily_revenue(*frames, from_day=today - timedelta(days=days), to_day=today - timedelta(days=1), **kw)


def daily_revenue_by_day(spark: SparkSession, *frames: DataFrame, day: date | str, **kw) -> DataFrame:
    """One section per day of the month so far; a day without takings has one empty row."""
    first, last = period(day)
    rows = daily_revenue(*frames, from_day=first, to_day=last, **kw)
    return day_spine(spark, first, last).join(rows, "day", "left").withColumn("section", F.dayofmonth("day"))


def stock_situation(
    openings: DataFrame, movements: DataFrame, locations: DataFrame, from_day: date | str,
    to_day: date | str | None = None, names: Sequence[str] = SITUATION_LOCATIONS,
) -> DataFrame:
    """Per day and location: opening of the day before, its movement, opening of the day.

    Openings are summed once per day and location; the day before is the same
    sum moved on by one day.
    """
    first, last = (as_day(from_day), as_day(to_day if to_day is not None else from_day))
    before = first - timedelta(days=1)
    listed = locations_in(locations, names).select("location_id", "name_norm")
    days = F.sequence(as_date(first), as_date(last), F.expr("INTERVAL 1 DAY"))
    spine = listed.select(F.explode(days).alias("day"), "location_id", "name_norm")
    held = sum_by(
        on_days(openings, "opening_date", before, last).withColumnRenamed("opening_date", "day"),
        ["day", "location_id"], "opening_qty", "open_qty",
    )
    prev = held.select(F.date_add("day", 1).alias("day"), "location_id", F.col("open_qty").alias("open_qty_prev"))
    curr = held.withColumnRenamed("open_qty", "open_qty_curr")
    moved = movement_io(
        on_days(movements, "movement_day", before, last - timedelta(days=1))
        .withColumn("day", F.date_add("movement_day", 1)),
        ["day", "location_id"],
    )
    return sorted_report(situation(spine, prev, curr, moved, ["day", "location_id"]), ["day", "name_norm"], desc=["name_norm"])


def stock_movement(movements: DataFrame, locations: DataFrame, products: DataFrame, from_day: date | str, to_day: date | str | None = None) -> DataFrame:
    """Net movement of own articles per day, location, side, usage and type."""
    moved = on_days(movements, "movement_day", from_day, to_day if to_day is not None else from_day)
    known = moved.filter(valid_barcode("barcode")).join(products.select("product_id"), "product_id", "left_semi")
    summed = known.groupBy(
        "movement_day", "location_id", "side", "location_usage", "is_internal", "movement_type"
    ).agg(F.sum(movement_qty("side", "qty")).alias("qty_final"))
    named = summed.join(locations.select("location_id", "name_norm"), "location_id")
    rows = named.select("movement_day", "location_id", "name_norm", "side", "location_usage", "is_internal", "movement_type", "qty_final")
    return sorted_report(rows, ["movement_day", "side", "location_usage", "movement_type", "name_norm"])


def stock_age_report(
    openings: DataFrame, products: DataFrame, locations: DataFrame, from_day: date | str, as_of: date | str,
    to_day: date | str | None = None, close_gap: bool = False,
) -> DataFrame:
    """Stock per age bucket and location, by how long it has been there on ``as_of``.

    Quantities are summed per location id and bucket first: one sum per row, and
    few rows to name.
    """
    held = on_days(openings, "opening_date", from_day, to_day if to_day is not None else from_day)
    known = held.join(products.select("product_id"), "product_id", "left_semi").withColumn(
        "bucket", age_bucket(age_days("in_date", as_of), close_gap)
    )
    summed = sum_by(known, ["opening_date", "location_id", "bucket"], "opening_qty", "qty")
    named = summed.join(locations.select("location_id", F.col("complete_name").alias("location")), "location_id")
    return sorted_report(by_bucket(named, ["opening_date", "location"], "bucket", "qty"), ["opening_date", "location"])


def detailed_revenue(lines: DataFrame, orders: DataFrame, from_day: date | str, to_day: date | str | None = None) -> DataFrame:
    """Order lines with shop, product and seller as named in the source records."""
    first, last = period(from_day, to_day)
    sold = on_days(lines, "txn_day", first, last).select(
        "txn_day", "order_id", json_path("payload", "$.product_id[1]").alias("product_name"),
        "barcode", "qty", "unit_price", "subtotal_excl_tax",
    )
    heads = orders.select(
        "order_id",
        json_path("payload", "$.config_id[1]").alias("pos_name"),
        json_path("payload", "$.employee_id[1]").alias("agent"),
    )
    return sorted_report(attach_order(sold, heads), ["pos_name", "order_id"])


def stock_opening_listing(openings: DataFrame, locations: DataFrame, products: DataFrame, from_day: date | str, to_day: date | str | None = None) -> DataFrame:
    """Openings of own articles."""
    held = on_days(openings, "opening_date", from_day, to_day if to_day is not None else from_day)
    own = products.filter(valid_barcode("barcode")).select("product_id", "barcode", F.col("name_norm").alias("product_name"))
    return with_dims(held, (locations.select("location_id", "name_norm"), "location_id"), (own, "product_id")).select(
        "opening_date", "product_id", "barcode", "product_name", "name_norm", "opening_qty", "unit_cost", "unit_sale_price"
    )


def stock_exceptions(openings: DataFrame, products: DataFrame, locations: DataFrame, from_day: date | str, to_day: date | str | None = None) -> DataFrame:
    """Openings of current products whose quantity or prices look wrong."""
    held = on_days(openings, "opening_date", from_day, to_day if to_day is not None else from_day).withColumns({
        "status_qty": qty_status("opening_qty"),
        "status_financial": fin_status("unit_sale_price", "unit_cost"),
    })
    odd = only_exceptions(held, "status_qty", "status_financial")
    return with_dims(
        odd,
        (current(products).select("product_id", "barcode", F.col("name_norm").alias("product_name"), F.col("category_norm").alias("category")), "product_id"),
        (locations.select("location_id", F.col("complete_name").alias("location")), "location_id"),
    ).select(
        "opening_date", "barcode", "location", "product_name", "category", "opening_qty", "unit_cost",
        "unit_sale_price", "status_qty", "status_financial",
    ).transform(sorted_report, ["location", "category"])
