"""Quant staging, the daily opening snapshot, and the opening-and-movement ledger."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import INTERNAL_USAGE, as_date, date_key, value
from comptoir.functions.names import TRACKED_KEYWORDS, UNTRACKED_PREFIXES, is_tracked_product
from comptoir.functions.records import m2o_id, parse_dt
from comptoir.operators.aggregates import max_ts_id
from comptoir.operators.filters import exclude_ids
from comptoir.operators.joins import with_dims
from comptoir.operators.merge import reload_parts, upsert
from comptoir.operators.sets import MOVE_SOURCE, OPENING_SOURCE, OPENING_TYPE, UNKNOWN_TYPE, stack
from comptoir.operators.windows import dedup_latest
from comptoir.schemas import QTY, QUANT_RELATIONS
from comptoir.sources.scans import scan_in_scope, with_payload
from comptoir.sources.slices import slice_since

# fixed values: location usages staged by default
QUANT_USAGES = ("internal", "inventory", "production", "transit")


def quant_slice(
    quants: DataFrame, locations: DataFrame, since_ts: datetime | str, since_id: int,
    usages: Sequence[str] = QUANT_USAGES, max_rows: int | None = None,
) -> DataFrame:
    """Quants written since a watermark at locations in scope."""
    raw = with_payload(quants, relations=QUANT_RELATIONS).withColumns({
        "written_at": parse_dt("write_date"), "location_id": m2o_id("location_id"),
    })
    return slice_since(scan_in_scope(raw, locations, usages), "written_at", "id", since_ts, since_id, max_rows, "write_date")


def load_quants(
    quants: DataFrame, locations: DataFrame, since_ts: datetime | str, since_id: int, as_of: datetime | str,
    target: DataFrame | None = None, usages: Sequence[str] = QUANT_USAGES, max_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Staged quants, and the watermark of the slice, from which the next load goes on."""
    return {
        "quants": stg_quant(quants, locations, since_ts, since_id, as_of, usages, max_rows, target),
        "watermark": max_ts_id(quant_slice(quants, locations, since_ts, since_id, usages, max_rows), "written_at", "id"),
    }


def stg_quant(
    quants: DataFrame, locations: DataFrame, since_ts: datetime | str, since_id: int, as_of: datetime | str,
    usages: Sequence[str] = QUANT_USAGES, max_rows: int | None = None, target: DataFrame | None = None,
) -> DataFrame:
    """Quants written since a watermark at locations in scope, latest version each."""
    changed = quant_slice(quants, locations, since_ts, since_id, usages, max_rows)
    new = dedup_latest(changed, ["id"], "written_at", ["payload"]).select(
        F.coalesce(F.col("written_at").cast("date"), as_date(str(as_of)[:10])).alias("part_day"),
        F.col("id").alias("quant_id"),
        "written_at",
        parse_dt("create_date").alias("created_at"),
        m2o_id("product_id").alias("product_id"),
        "location_id",
        m2o_id("company_id").alias("company_id"),
        m2o_id("lot_id").alias("lot_id"),
        F.col("quantity").cast(QTY).alias("quantity"),
        F.col("reserved_quantity").cast(QTY).alias("reserved_quantity"),
        parse_dt("in_date").alias("in_date"),
        "payload",
    )
    return new if target is None else upsert(target, new, ["quant_id"])


def fct_stock_opening(
    quants: DataFrame, locations: DataFrame, products: DataFrame, day: date | str,
    only_internal: bool = True, excluded_locations: Sequence[int] = (), keep_negative: bool = False,
    keywords: Sequence[str] = TRACKED_KEYWORDS, untracked: Sequence[str] = UNTRACKED_PREFIXES, strip: bool = True,
) -> DataFrame:
    """Valued stock of tracked products on one day.

    ``quants`` has ``product_id, location_id, quantity, in_date``; ``products``
    ``product_id, display_name, sale_ok, standard_price, lst_price``.
    """
    held = quants.filter(F.col("product_id").isNotNull() & F.col("location_id").isNotNull())
    held = held.filter(F.col("quantity") != 0 if keep_negative else F.col("quantity") > 0)
    if only_internal:
        held = scan_in_scope(held, locations, [INTERNAL_USAGE])
    held = exclude_ids(held, excluded_locations)
    tracked = products.filter(is_tracked_product("display_name", "sale_ok", keywords, untracked, strip)).select(
        "product_id",
        F.coalesce(F.col("standard_price").cast(QTY), F.lit(0).cast(QTY)).alias("unit_cost"),
        F.coalesce(F.col("lst_price").cast(QTY), F.lit(0).cast(QTY)).alias("unit_sale_price"),
    )
    size = F.col("quantity").cast(QTY)
    sign = F.signum(F.col("quantity")).cast("int")
    return with_dims(held, (tracked, "product_id")).select(
        as_date(day).alias("opening_date"),
        "product_id", "location_id",
        size.alias("opening_qty"),
        "unit_cost", "unit_sale_price",
        (sign * value(size, "unit_cost")).cast("decimal(18,4)").alias("value_cost"),
        (sign * value(size, "unit_sale_price")).cast("decimal(18,4)").alias("value_sale"),
        F.coalesce(F.col("in_date").cast("date"), as_date(day)).alias("in_date"),
    )


def ledger(opening: DataFrame, movements: DataFrame, products: DataFrame) -> DataFrame:
    """Openings of all products, then movements of own locations that have a barcode.

    A movement's quantity is its signed one in both quantity columns.
    """
    zero = F.lit(0).cast(QTY)
    first = opening.join(products.select("product_id", "barcode"), "product_id", "left").select(
        date_key("opening_date").alias("date_key"),
        F.col("opening_date").alias("day"),
        "location_id", "barcode",
        F.col("opening_qty").alias("qty"),
        F.col("opening_qty").alias("signed_qty"),
        "unit_cost", "unit_sale_price",
        F.lit(OPENING_TYPE).alias("movement_type"),
        F.lit(OPENING_SOURCE).alias("source_type"),
    )
    own = F.col("barcode").isNotNull() & F.col("is_internal") & (F.col("location_usage") == INTERNAL_USAGE)
    second = movements.filter(own).select(
        "date_key",
        F.col("movement_day").alias("day"),
        "location_id", "barcode",
        F.col("signed_qty").alias("qty"),
        "signed_qty",
        F.coalesce("unit_cost", zero).alias("unit_cost"),
        F.coalesce("unit_sale_price", zero).alias("unit_sale_price"),
        F.coalesce("movement_type", F.lit(UNKNOWN_TYPE)).alias("movement_type"),
        F.lit(MOVE_SOURCE).alias("source_type"),
        "move_line_id",
    )
    return stack(first, second)


def store_opening(opening: DataFrame, path: str, day: date | str) -> list[str]:
    """A day's opening in place of whatever was stored for the day."""
    return reload_parts(opening.sparkSession, path, opening, "opening_date", day, day)
