"""Dimensions: employees, shops, products, locations, payment methods.

Each function takes raw source records and the stored dimension, if there is
one, and returns the new dimension.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.functions.measures import as_ts, surrogate_key
from comptoir.functions.names import (
    CATEGORY_KEYWORDS, CATEGORY_PREFIX, canon_uom, has_code_prefix, location_key, norm_product,
    norm_site, pos_category,
)
from comptoir.functions.records import clean_false, m2o_id, m2o_name, parse_dt
from comptoir.operators.aggregates import duplicates, max_ts_id
from comptoir.operators.joins import category_paths, enrich_product
from comptoir.operators.merge import retire_missing, upsert
from comptoir.operators.windows import dedup_latest
from comptoir.sources.scans import first_available
from comptoir.sources.slices import slice_since


def _merged(new: DataFrame, target: DataFrame | None, keys: list[str], **how) -> DataFrame:
    return new if target is None else upsert(target, new, keys, **how)


def _text(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def dim_employee(employees: DataFrame, as_of: datetime | str, target: DataFrame | None = None) -> DataFrame:
    new = employees.select(
        F.col("id").alias("employee_id"),
        "name",
        clean_false("work_email").alias("work_email"),
        m2o_name("job_id").alias("job_title"),
        m2o_name("department_id").alias("department"),
        "active",
        as_ts(as_of).alias("updated_at"),
    )
    return _merged(new, target, ["employee_id"])


def dim_shop(configs: DataFrame, as_of: datetime | str, target: DataFrame | None = None) -> DataFrame:
    new = configs.select(
        F.col("id").alias("shop_id"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce(m2o_id("company_id"), F.lit(0)).alias("company_id"),
        F.coalesce("active", F.lit(True)).alias("is_active"),
        F.lit(True).alias("is_current"),
        as_ts(as_of).alias("created_at"),
        as_ts(as_of).alias("updated_at"),
    )
    return _merged(new, target, ["shop_id"], insert_only=["created_at"])


def product_slice(products: DataFrame, since_ts: datetime | str, since_id: int, max_rows: int | None = None) -> DataFrame:
    """Active products with a barcode, written since a watermark."""
    base = products.filter(F.col("active") & F.col("barcode").isNotNull() & (F.col("barcode") != "false"))
    base = base.withColumns({
        "written_at": parse_dt("write_date"),
        "template_id": m2o_id("product_tmpl_id"),
    })
    return slice_since(base, "written_at", "id", since_ts, since_id, max_rows, "write_date")


def load_products(
    products: DataFrame, templates: DataFrame, units: DataFrame, categories: DataFrame,
    since_ts: datetime | str, since_id: int, as_of: datetime | str, target: DataFrame | None = None,
    max_rows: int | None = None, **scope,
) -> dict[str, DataFrame]:
    """The dimension after a load, its audits (every version touched, and ids with several), and the watermark
    of the slice, from which the next load goes on."""
    changed = changed_products(products, templates, units, categories, since_ts, since_id, as_of, max_rows, **scope)
    return {
        "products": dim_product(changed, target),
        "touched": changed.select("product_id", "name_raw", "category_norm", "barcode", "updated_at"),
        "duplicates": duplicates(changed.select("product_id", "name_raw", "updated_at"), ["product_id"]),
        "watermark": max_ts_id(product_slice(products, since_ts, since_id, max_rows), "written_at", "id"),
    }


def changed_products(
    products: DataFrame, templates: DataFrame, units: DataFrame, categories: DataFrame,
    since_ts: datetime | str, since_id: int, as_of: datetime | str, max_rows: int | None = None,
    keywords: tuple[str, ...] = CATEGORY_KEYWORDS, prefix: str = CATEGORY_PREFIX,
) -> DataFrame:
    """Coded products of a sales category changed since a watermark, all versions."""
    changed = product_slice(products, since_ts, since_id, max_rows).filter(has_code_prefix("name"))
    tmpl = templates.select(
        F.col("id").alias("template_id"), m2o_id("categ_id").alias("category_id"), m2o_id("uom_id").alias("uom_id")
    )
    uoms = units.select(F.col("id").alias("uom_id"), F.col("name").alias("uom_name"))
    tree = categories.select("id", "name", m2o_id("parent_id").alias("parent_id"))
    paths = category_paths(tree).withColumnsRenamed({"id": "category_id", "path": "category_raw"})
    now = as_ts(as_of)
    return (
        enrich_product(changed, tmpl, uoms, paths)
        .withColumn("category_norm", pos_category("category_raw", keywords, prefix))
        .filter(F.col("category_norm").isNotNull())
        .select(
            surrogate_key("id").alias("product_key"),
            F.col("id").alias("product_id"),
            "category_norm",
            norm_product("name").alias("name_norm"),
            "category_raw",
            "active",
            canon_uom("uom_name").alias("uom"),
            F.coalesce(parse_dt("create_date"), now).alias("created_at"),
            F.coalesce("written_at", now).alias("updated_at"),
            F.lit(True).alias("is_current"),
            "barcode",
            F.col("name").alias("name_raw"),
        )
    )


def dim_product(changed: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Latest version per product; a match leaves unit, raw category and flag alone."""
    latest = dedup_latest(changed, ["product_id"], "updated_at", ["name_raw"])
    return _merged(
        latest, target, ["product_id"],
        update_cols=["category_norm", "name_norm", "active", "updated_at", "barcode"],
        keep_if_null=["barcode"],
    )


def dim_location(locations: DataFrame, as_of: datetime | str, target: DataFrame | None = None) -> DataFrame:
    full_name = F.trim(F.coalesce(clean_false("complete_name"), clean_false("name"), F.lit("")))
    new = locations.select(
        surrogate_key("id").alias("location_key"),
        F.col("id").alias("location_id"),
        full_name.alias("complete_name"),
        F.trim(F.coalesce(clean_false("usage"), F.lit("internal"))).alias("usage"),
        norm_site(full_name).alias("site_norm"),
        location_key(full_name).alias("name_norm"),
        m2o_id("location_id").alias("parent_id"),
        F.coalesce("active", F.lit(True)).alias("is_current"),
        as_ts(as_of).alias("created_at"),
        as_ts(as_of).alias("updated_at"),
    )
    return _merged(new, target, ["location_id"], insert_only=["location_key", "created_at"])


def dim_payment_method(
    methods: DataFrame, journals: DataFrame, as_of: datetime | str, target: DataFrame | None = None,
    journal_column: str | None = None,
) -> DataFrame:
    """Methods with their journal; those missing from the extract are retired."""
    journal = first_available(methods, forced=journal_column)
    known = journals.select(
        F.col("id").alias("journal_id"), F.col("name").alias("journal_name"), F.col("type").alias("journal_type")
    )
    now = as_ts(as_of)
    new = (
        methods.select(
            "id", "name", "active", "create_date", "write_date",
            m2o_id(journal).alias("journal_id"), m2o_name(journal).alias("own_name"),
        )
        .join(known, "journal_id", "left")
        .select(
            F.col("id").alias("method_id"),
            _text("name").alias("name"),
            "journal_id",
            F.coalesce("journal_name", "own_name").alias("journal_name"),
            "journal_type",
            F.coalesce("active", F.lit(True)).alias("is_current"),
            F.coalesce(parse_dt("create_date"), now).alias("created_at"),
            parse_dt("write_date").alias("updated_at"),
        )
    )
    if target is None:
        return new
    merged = upsert(target, new, ["method_id"], insert_only=["created_at"])
    return retire_missing(merged, new, "method_id", stamp="updated_at", as_of=now)
