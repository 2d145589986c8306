"""Point of sale: daily line staging, history loads, and the order facts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.functions.measures import as_ts, payment_dt, split_overflow
from comptoir.functions.records import clean_false, m2o_id, m2o_name, parse_dt
from comptoir.operators.aggregates import payment_summary, payment_text
from comptoir.operators.incremental import since_from_target
from comptoir.operators.joins import attach_order, fill_from, restrict_to
from comptoir.operators.merge import file_system, remove, upsert
from comptoir.operators.skew import splittable_join
from comptoir.operators.windows import top_one
from comptoir.schemas import (
    ORDER_LINE_RELATIONS, ORDER_RELATIONS, PAYMENT_RELATIONS, QTY, SESSION_RELATIONS,
)
from comptoir.sources.scans import record_json, with_payload
from comptoir.session import cut_lineage, scratch_path, write_scratch
from comptoir.sources.slices import not_before, slice_last, slice_range

# fixed values
UNPAID, UNKNOWN_ORDER = "NON PAYÉ", "INCONNU"
MISSING_ID = 0


def _money(c: str) -> Column:
    return F.col(c).cast(QTY)


def stg_pos_line(
    lines: DataFrame, orders: DataFrame, payments: DataFrame, as_of: datetime | str,
    targets: dict[str, DataFrame] | None = None, hours: int = 24,
) -> dict[str, DataFrame]:
    """Lines of the last hours, and per order its name and payment text.

    The texts are kept once per order: on every line, the text of an order grows
    with the square of its size. ``with_payment_text`` puts the two together.
    """
    recent = slice_last(
        lines.withColumn("created_at", parse_dt("create_date")), "created_at", as_of, hours=hours, inclusive=True,
        text="create_date",
    ).withColumn("order_id", m2o_id("order_id"))
    keys = recent.select("order_id")
    paid = payments.select(
        m2o_id("pos_order_id").alias("order_id"), F.col("id").alias("payment_id"),
        m2o_id("payment_method_id").alias("method_id"), m2o_name("payment_method_id").alias("method_name"),
        _money("amount").alias("amount"),
    )
    texts = payment_text(restrict_to(paid, keys, "order_id"))
    named = orders.select(F.col("id").alias("order_id"), F.col("name").alias("order_name"))
    new_lines = splittable_join(recent, named, "order_id", "left").select(
        F.col("id").alias("line_id"),
        "order_id",
        m2o_id("product_id").alias("product_id"),
        _money("qty").alias("qty"),
        _money("price_unit").alias("price_unit"),
        _money("discount").alias("discount_percent"),
        _money("price_subtotal_incl").alias("subtotal_incl_tax"),
        "created_at",
        F.coalesce("order_name", F.lit(UNKNOWN_ORDER)).alias("pos_reference"),
        as_ts(as_of).alias("ingested_at"),
    )
    if not targets:
        return {"lines": new_lines, "payment_texts": texts}
    changing = ["qty", "price_unit", "pos_reference", "ingested_at"]
    return {
        "lines": upsert(targets["lines"], new_lines, ["line_id", "created_at"], update_cols=changing, latest=("created_at", ["product_id", "qty", "price_unit", "discount_percent", "subtotal_incl_tax"])),
        "payment_texts": upsert(targets["payment_texts"], texts, ["order_id", "part"]),
    }


def with_payment_text(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines with the payment text of their order; meant for orders of ordinary size."""
    whole = texts.groupBy("order_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "payment_text"))).alias("parts")
    ).select("order_id", F.array_join(F.col("parts.payment_text"), " | ").alias("payment_text"))
    return splittable_join(lines, whole, "order_id", "left").withColumn(
        "payment_method_name", F.coalesce("payment_text", F.lit(UNPAID))
    ).drop("payment_text")


def _order_columns(order_id: str, strict: bool, as_of: datetime | str) -> list[Column]:
    placed, written = parse_dt("date_order"), parse_dt("write_date")
    session, config = m2o_id("session_id"), m2o_id("config_id")
    if not strict:
        placed = F.coalesce(placed, written, as_ts(as_of))
        session, config = (F.coalesce(c, F.lit(MISSING_ID)) for c in (session, config))
    return [
        F.col(order_id).alias("order_id"),
        session.alias("session_id"),
        config.alias("config_id"),
        placed.alias("txn_ts"),
        placed.cast("date").alias("txn_day"),
        m2o_id("employee_id").alias("employee_id"),
        m2o_id("partner_id").alias("partner_id"),
        _money("amount_tax").alias("amount_tax"),
        _money("amount_total").alias("amount_total"),
        _money("amount_paid").alias("amount_paid"),
        _money("amount_return").alias("amount_return"),
        "state",
    ]


def pos_hist(
    orders: DataFrame, lines: DataFrame, payments: DataFrame, from_: datetime | str, to: datetime | str,
    as_of: datetime | str, targets: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Range load of lines by creation time, with the orders and payments they name.

    Also returns the payments whose amount does not fit the target type.
    """
    in_range = _lines_in_range(lines, from_, to)
    return _hist_tables(in_range, _named_by(in_range, orders, F.col("id")), _named_by(in_range, payments, m2o_id("pos_order_id")), as_of, targets)


def _lines_in_range(lines: DataFrame, from_: datetime | str, to: datetime | str) -> DataFrame:
    return slice_range(
        lines.withColumns({"created_at": parse_dt("create_date"), "order_id": m2o_id("order_id")}),
        "created_at", from_, to, "create_date",
    ).filter(F.col("order_id").isNotNull())


def _named_by(in_range: DataFrame, records: DataFrame, order: Column) -> DataFrame:
    """Records of the orders that the lines name, with their raw columns alone."""
    keys = in_range.select(F.col("order_id").alias("__order"))
    return restrict_to(records.withColumn("__order", order), keys, "__order").drop("__order")


def _hist_tables(
    in_range: DataFrame, orders: DataFrame, payments: DataFrame, as_of: datetime | str, targets: dict[str, DataFrame] | None,
) -> dict[str, DataFrame]:
    """The tables of a history load, from the lines in range and the orders and payments that these name. Payloads are
    made here, so what is shuffled to find those records carries each value once."""
    heads = with_payload(orders, relations=ORDER_RELATIONS).withColumn("order_id", F.col("id"))
    reference = F.coalesce(clean_false("pos_reference"), clean_false("name"))
    order_rows = heads.select(
        *_order_columns("order_id", False, as_of),
        reference.alias("pos_reference"),
        clean_false("uuid").alias("uuid"),
        parse_dt("write_date").alias("write_ts"),
        "payload",
        as_ts(as_of).alias("ingested_at"),
    )
    paid = with_payload(payments, relations=PAYMENT_RELATIONS).withColumns({
        "order_id": m2o_id("pos_order_id"),
        "method_id": m2o_id("payment_method_id"),
        "method_name": m2o_name("payment_method_id"),
        "paid_amount": F.coalesce("amount", F.lit(0)),
    })
    paid, rejected = split_overflow(paid, "paid_amount")
    paid_at = payment_dt(parse_dt("payment_date"), parse_dt("create_date"), parse_dt("write_date"))
    payment_rows = paid.select(
        F.col("id").alias("payment_id"),
        "order_id",
        paid_at.alias("payment_ts"),
        paid_at.cast("date").alias("payment_day"),
        "method_id",
        _money("paid_amount").alias("amount"),
        parse_dt("write_date").alias("write_ts"),
        "payload",
        as_ts(as_of).alias("ingested_at"),
    )
    summary = payment_summary(paid.select("order_id", "method_id", "method_name", _money("paid_amount").alias("amount")))
    refs = heads.select("order_id", reference.alias("pos_reference"))
    per_order = refs.join(summary, "order_id", "full")
    line_rows = splittable_join(in_range, per_order, "order_id", "left").select(
        F.col("id").alias("line_id"),
        "order_id",
        m2o_id("product_id").alias("product_id"),
        F.lit(None).cast("bigint").alias("stock_move_id"),
        _money("qty").alias("qty"),
        _money("price_unit").alias("price_unit"),
        _money("discount").alias("discount_percent"),
        _money("price_subtotal_incl").alias("subtotal_incl_tax"),
        "method_id",
        F.col("payment_text").alias("payment_method_name"),
        "created_at",
        "pos_reference",
        as_ts(as_of).alias("ingested_at"),
    )
    new = {"orders": order_rows, "lines": line_rows, "payments": payment_rows}
    ids = {"orders": "order_id", "lines": "line_id", "payments": "payment_id"}
    last = {
        "orders": ("write_ts", ["payload"]), "payments": ("write_ts", ["payload"]),
        "lines": ("created_at", ["product_id", "qty", "price_unit", "discount_percent", "subtotal_incl_tax"]),
    }
    out = {
        k: upsert(targets[k], df, [ids[k]], latest=last[k]) if targets and k in targets else df
        for k, df in new.items()
    }
    return {**out, "rejected_payments": rejected}


def load_pos_hist(
    orders: DataFrame, lines: DataFrame, payments: DataFrame, from_: datetime | str, to: datetime | str,
    as_of: datetime | str, targets: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """``pos_hist`` with each source scanned once and all tables written by one job.

    The lines of the range, then the orders and payments they name, are staged; everything else starts from those, and
    they are not looked up again. The tables are the branches of one written frame, split by kind, and are read back from their folders.
    """
    spark = orders.sparkSession
    in_range = cut_lineage(_lines_in_range(lines, from_, to))
    named = cut_lineage(_named_by(in_range, orders, F.col("id")))
    paid = cut_lineage(_named_by(in_range, payments, m2o_id("pos_order_id")))
    tables = _hist_tables(in_range, named, paid, as_of, targets)
    tagged = [df.select(F.lit(kind).alias("kind"), F.struct(*df.columns).alias(kind)) for kind, df in tables.items()]
    path = scratch_path(spark, "history")
    write_scratch(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), path, "kind")
    for staged in (in_range, named, paid):  # the tables are read from the history folder alone
        for folder in staged.inputFiles()[:1]:
            remove(spark, folder.rsplit("/", 1)[0])
    read = spark.read
    return {kind: read.schema(t.select(kind).schema).parquet(f"{path}/kind={kind}").select(f"{kind}.*") if _written(spark, f"{path}/kind={kind}") else spark.createDataFrame([], tables[kind].schema) for kind, t in zip(tables, tagged)}


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a branch had rows: one without any leaves no folder."""
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def fct_pos_order(orders: DataFrame, as_of: datetime | str) -> DataFrame:
    return with_payload(orders, relations=ORDER_RELATIONS).select(
        *_order_columns("id", True, as_of),
        clean_false("pos_reference").alias("pos_reference"),
        clean_false("uuid").alias("uuid"),
        parse_dt("write_date").alias("write_ts"),
        "payload",
        as_ts(as_of).alias("loaded_at"),
    ).filter(F.col("txn_ts").isNotNull())


def fct_pos_line(lines: DataFrame, orders: DataFrame, products: DataFrame, as_of: datetime | str) -> DataFrame:
    """Lines with the times and shop of their order, and the barcode of their product.

    The lines meet their orders and products as they are read; their typed columns and payload are made after those
    joins, so their shuffles carry each value once.
    """
    head = orders.select(
        F.col("order_id").alias("__order"), F.col("config_id").alias("__config"),
        F.col("txn_ts").alias("__txn_ts"), F.col("txn_day").alias("__txn_day"),
    )
    raw = lines.columns
    joined = attach_order(lines.withColumn("__order", m2o_id("order_id")), head, "__order")
    named = joined.withColumns({"__product": m2o_id("product_id"), "__barcode": F.lit(None).cast("string")})
    coded = fill_from(named, products.select(F.col("product_id").alias("__product"), F.col("barcode").alias("__barcode")), "__product", "__barcode")
    return coded.select(
        F.col("__order").alias("order_id"),
        F.col("id").alias("line_id"),
        F.col("__product").alias("product_id"),
        F.col("__barcode").alias("barcode"),
        _money("qty").alias("qty"),
        _money("price_unit").alias("unit_price"),
        _money("discount").alias("discount_percent"),
        _money("price_subtotal").alias("subtotal_excl_tax"),
        _money("price_subtotal_incl").alias("subtotal_incl_tax"),
        parse_dt("write_date").alias("write_ts"),
        record_json(raw, [c for c in ORDER_LINE_RELATIONS if c in raw]).alias("payload"),
        as_ts(as_of).alias("loaded_at"),
        F.col("__config").alias("config_id"), F.col("__txn_ts").alias("txn_ts"), F.col("__txn_day").alias("txn_day"),
    )


def fct_pos_payment(payments: DataFrame, orders: DataFrame, as_of: datetime | str) -> DataFrame:
    """Payments with the shop of their order; an undated one counts for the order day."""
    head = orders.select("order_id", "config_id", "txn_day")
    typed = with_payload(payments, relations=PAYMENT_RELATIONS).select(
        F.col("id").alias("payment_id"),
        m2o_id("pos_order_id").alias("order_id"),
        m2o_id("payment_method_id").alias("method_id"),
        _money("amount").alias("amount"),
        "is_change",
        parse_dt("payment_date").alias("given_ts"),
        parse_dt("write_date").alias("write_ts"),
        "payload",
        as_ts(as_of).alias("loaded_at"),
    )
    paid_at = payment_dt(F.col("given_ts"), order_day=F.col("txn_day"))
    return (
        attach_order(typed, head)
        .withColumns({"payment_ts": paid_at, "payment_day": paid_at.cast("date")})
        .drop("given_ts", "txn_day")
    )


def fct_pos_session(sessions: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    recent = slice_last(
        with_payload(sessions, relations=SESSION_RELATIONS).withColumn("__at", parse_dt("write_date")), "__at", as_of, days=days, inclusive=True,
        text="write_date",
    )
    return recent.select(
        F.col("id").alias("session_id"),
        m2o_id("config_id").alias("config_id"),
        parse_dt("start_at").alias("start_ts"),
        parse_dt("stop_at").alias("stop_ts"),
        "state", "payload",
        as_ts(as_of).alias("loaded_at"),
    )


def fct_pos(
    orders: DataFrame, lines: DataFrame, payments: DataFrame, sessions: DataFrame, products: DataFrame,
    as_of: datetime | str, targets: dict[str, DataFrame] | None = None, buffer: str = "INTERVAL 48 HOURS",
) -> dict[str, DataFrame]:
    """All four facts; lines and payments also find orders loaded earlier.

    With ``targets`` each source is read from the latest write its own target holds, less ``buffer``; the
    latest version of each id is merged, and stored lines without a barcode take the one their product has
    by now. What the other facts need of the orders, four columns, is written once and read by them.
    """
    targets = targets or {}

    def recent(name: str, source: DataFrame) -> DataFrame:
        if name not in targets:
            return source
        start = since_from_target(targets[name], "write_ts", buffer).first()["since_ts"]
        return source.filter(not_before("write_date", start) & (parse_dt("write_date") >= as_ts(start)))

    def merged(name: str, new: DataFrame, key: str) -> DataFrame:
        if name not in targets:
            return new
        if "write_ts" in new.columns:
            return upsert(targets[name], new, [key], latest=("write_ts", ["payload"]))
        return upsert(targets[name], top_one(new, [key], ["payload"]), [key])

    all_orders = merged("orders", fct_pos_order(recent("orders", orders), as_of), "order_id")
    heads = cut_lineage(all_orders.select("order_id", "config_id", "txn_ts", "txn_day"))
    all_lines = merged("lines", fct_pos_line(recent("lines", lines), heads, products, as_of), "line_id")
    if "lines" in targets:
        all_lines = fill_from(all_lines, products, "product_id", "barcode")
    return {
        "orders": all_orders,
        "lines": all_lines,
        "payments": merged("payments", fct_pos_payment(recent("payments", payments), heads, as_of), "payment_id"),
        "sessions": merged("sessions", fct_pos_session(sessions, as_of), "session_id"),
    }
