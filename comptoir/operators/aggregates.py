"""Aggregations. Grouped sums, counts and maxima are combined inside each task
before the shuffle, so a group of any size sends one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import (
    SOURCE_SIDE, TARGET_SIDE, as_ts, movement_qty, plain_number,
)
from comptoir.functions.names import valid_barcode
from comptoir.operators.positions import with_positions
from comptoir.operators.skew import splittable_join

# ---- fixed values -------------------------------------------------------
PAY_METHODS = {
    "makuta": "POS MAKUTA",
    "ecobank": "ECOBANK",
    "uba": "UBA",
    "orange": "Orange money",
    "m_pesa": "M-PESA",
    "caisse_recette": "Caisse RECETTE",
}
CASH_METHOD = "caisse_recette"
AGE_BUCKETS = {
    "stock_lt_30": (None, 30),
    "stock_30_90": (30, 90),
    "stock_90_180": (90, 180),
    "stock_180_360": (180, 360),
    "stock_gt_360": (360, None),
}
DEFAULT_START = "2000-01-01 00:00:00"
# -------------------------------------------------------------------------

TEXT_PART = 100_000


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(alias))


def pay_by_method(
    df: DataFrame, keys: Sequence[str], methods: Mapping[str, str] = PAY_METHODS,
    amount: str = "amount", method: str = "method_name", total: str = "total",
) -> DataFrame:
    """Total and one sum per payment method; NULL where a method has no row."""
    per_method = [
        F.sum(F.when(F.col(method) == name, F.col(amount))).alias(col) for col, name in methods.items()
    ]
    return df.groupBy(*keys).agg(F.sum(amount).alias(total), *per_method)


def movement_io(moves: DataFrame, keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """In, out and net quantity of own articles."""
    size = F.abs(F.col("qty"))
    both = moves.filter(valid_barcode("barcode")).groupBy(*keys).agg(
        F.sum(F.when(F.col("side") == TARGET_SIDE, size).otherwise(0)).alias("in_qty"),
        F.sum(F.when(F.col("side") == SOURCE_SIDE, size).otherwise(0)).alias("out_qty"),
    )
    return both.withColumn("net_movement", F.col("in_qty") - F.col("out_qty"))


def movement_by_location(moves: DataFrame) -> DataFrame:
    """Net quantity per day, location, side, usage, internal flag and type."""
    return moves.groupBy(
        "movement_day", "location_id", "name_norm", "side", "location_usage", "is_internal", "movement_type"
    ).agg(F.sum(movement_qty("side", "qty")).alias("qty_final"))


def age_bucket(age: Column, close_gap: bool = False) -> Column:
    """Name of the bucket an age falls in. An age of exactly 360 days is in none
    unless ``close_gap``; a missing age never is."""
    named = []
    for name, (low, high) in AGE_BUCKETS.items():
        inside = age < high if high is not None else (age >= low if close_gap else age > low)
        if low is not None and high is not None:
            inside = inside & (age >= low)
        named.append(F.when(inside, F.lit(name)))
    return F.coalesce(*named)


def by_bucket(df: DataFrame, keys: Sequence[str], bucket: Column | str, qty: str) -> DataFrame:
    """One sum per age bucket; a key without any bucket keeps its row."""
    bucket = F.col(bucket) if isinstance(bucket, str) else bucket
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(bucket == name, F.col(qty)).otherwise(0)).alias(name) for name in AGE_BUCKETS]
    )


def stock_age(
    opening: DataFrame, keys: Sequence[str], age: Column | str = "age_days", qty: str = "opening_qty",
    close_gap: bool = False,
) -> DataFrame:
    """Quantity per age bucket."""
    age = F.col(age) if isinstance(age, str) else age
    return by_bucket(opening.withColumn("__bucket", age_bucket(age, close_gap)), keys, "__bucket", qty)


def payment_text(
    payments: DataFrame, order: str = "order_id", seq: str = "payment_id",
    name: str = "method_name", amount: str = "amount", method: str = "method_id", prefix: str = "PM_",
    part_size: int = TEXT_PART,
) -> DataFrame:
    """``name: amount`` of an order's payments in arrival order, set off by bars.

    The contract is a row per order and ``part``: part p holds the payments at positions
    ``p * part_size`` to ``(p + 1) * part_size - 1``, so that no single value grows with the data. Payments
    stand in the order of ``seq``, missing ones last, then of their text. A payment without a name has
    ``prefix`` and its method id, one without an amount zero.

    Positions are exact and come from counts, whatever the sequence numbers look like: they may repeat or be
    missing, and an order may hold any share of the payments. What is collected is ``part_size`` payments.
    """
    known = F.col(method).cast("string") if method in payments.columns else F.lit(None).cast("string")
    label = F.coalesce(F.col(name), F.concat(F.lit(prefix), F.coalesce(known, F.lit(""))))
    piece = F.concat(label, F.lit(": "), plain_number(F.coalesce(F.col(amount), F.lit(0).cast(payments.schema[amount].dataType))))
    told = payments.select(order, F.col(seq).alias("seq"), piece.alias("piece"))
    placed = with_positions(told, [order], [F.col("seq").asc_nulls_last(), F.col("piece")])
    parts = placed.groupBy(order, F.floor(F.col("position") / part_size).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("position", "piece"))).alias("pieces")
    )
    return parts.select(order, "part", F.array_join(F.col("pieces.piece"), " | ").alias("payment_text"))


def payment_summary(
    payments: DataFrame, order: str = "order_id", method: str = "method_id",
    name: str = "method_name", amount: str = "amount", prefix: str = "PM_",
) -> DataFrame:
    """Amount per method as text by method id, and the id itself if there is only one.

    The first sum leaves one row per order and method, so what is collected per
    order is bounded by the number of methods.
    """
    label = F.coalesce(F.max(name), F.concat(F.lit(prefix), F.col(method).cast("string")))
    per_method = (
        payments.filter(F.col(method).isNotNull())
        .groupBy(order, method)
        .agg(label.alias("label"), F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("amount"))
    )
    part = F.concat(F.col("label"), F.lit(": "), plain_number("amount"))
    return per_method.groupBy(order).agg(
        F.when(F.count(F.lit(1)) == 1, F.min(method)).alias("method_id"),
        F.array_sort(F.collect_list(F.struct(F.col(method).alias("m"), part.alias("part")))).alias("parts"),
    ).select(order, "method_id", F.array_join(F.col("parts.part"), " | ").alias("payment_text"))


def max_ts(df: DataFrame, col: str, default: str = DEFAULT_START) -> DataFrame:
    """Greatest timestamp, or the default start for an empty frame."""
    return df.agg(F.coalesce(F.max(col), as_ts(default)).alias("max_ts"))


def max_ts_id(df: DataFrame, ts: str = "write_date", key: str = "id") -> DataFrame:
    """Greatest ``(ts, id)`` pair among rows that have both."""
    usable = df.filter(F.col(ts).isNotNull() & F.col(key).isNotNull())
    top = F.max(F.struct(F.col(ts).alias("ts"), F.col(key).alias("id")))
    return usable.agg(top.alias("top")).select(
        F.col("top.ts").alias("watermark_ts"), F.col("top.id").alias("watermark_id")
    )


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).dropna().distinct()


def duplicates(df: DataFrame, key: Sequence[str], count: str = "occurrences") -> DataFrame:
    """Every row whose key occurs more than once, with how often it does; missing keys equal each other."""
    key = list(key)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
    return splittable_join(df, counts, key, null_safe=True)


def load_stats(df: DataFrame, ts: str, as_of: datetime | str, minutes: int = 5) -> DataFrame:
    """Total rows, and rows touched in the last minutes."""
    recent = F.col(ts) > as_ts(as_of) - F.expr(f"INTERVAL {minutes} MINUTES")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(recent).alias("recent_rows")
    )


def opening_summary(opening: DataFrame, keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """Quantity, cost value and sale value of an opening per location."""
    return opening.groupBy(*keys).agg(
        F.sum("opening_qty").alias("qty"),
        F.sum("value_cost").alias("cost"),
        F.sum("value_sale").alias("price"),
    )
