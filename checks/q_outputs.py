"""Whole outputs of the datasets: every column is compared, the records kept as JSON field by field, and loads start late
enough to leave stored rows alone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.q_datasets import (
    AS_OF, ENTRIES_SQL, HIST, HIST_KEYS, PART_KEYWORDS, PRODUCT_SQL, exact_payments, facts, history, latest_expenses, old_expenses,
    staged_lines,
)
from checks.q_relational import rules
from checks.registry import QUERIES, query
from comptoir.plans import dimensions as dim
from comptoir.plans import expenses as ex
from comptoir.plans import movements as mv
from comptoir.plans import pos, stock
from comptoir.session import cut_lineage, scratch_path
from comptoir.sources import files

NO_TEXT = "CAST(NULL AS STRING)"


def opened(df: DataFrame, raw: DataFrame, record: Column | str = "payload") -> DataFrame:
    """The columns of ``df``, with the record in its payload as one column per field, ``p_`` before its name."""
    text = F.col(record) if isinstance(record, str) else record
    fields = df.withColumn("__record", F.from_json(text, raw.schema))
    return fields.select(*[c for c in df.columns if c != "payload"], *[F.col(f"__record.{c}").alias(f"p_{c}") for c in raw.columns])


def record(columns: str, table: str = "r") -> str:
    return ", ".join(f"{table}.{c} AS p_{c}" for c in columns.split())


def rid(c: str) -> str:
    return f"CAST(json_extract_string({c}, '$[0]') AS BIGINT)"


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(16,4)) AS DOUBLE)"


def text(c: str) -> str:
    return f"CASE WHEN {c} <> 'false' THEN {c} END"


MOVE_LINE = "id move_id picking_id product_id location_id location_dest_id qty_done product_uom_id state date write_date reference"


@query("ds_07_whole_lines", f"""
    SELECT r.write_date[1:10] AS part_day, r.id AS move_line_id, {rid('r.move_id')} AS move_id, {rid('r.picking_id')} AS picking_id, {NO_TEXT} AS business_ts,
           r.write_date AS write_ts, r.state, {rid('r.product_id')} AS product_id, {rid('r.location_id')} AS location_id,
           {rid('r.location_dest_id')} AS location_dest_id, {money('r.qty_done')} AS qty_done, 'Units' AS uom_name, {text('p.barcode')} AS barcode,
           {money('coalesce(p.list_price, 0)')} AS unit_sale_price, {money('coalesce(p.standard_price, 0)')} AS unit_cost,
           md5(CAST(r.id AS STRING) || '|' || r.write_date || '|' || regexp_replace(CAST(CAST(r.qty_done AS DECIMAL(20,4)) AS STRING), '0{{{{1,3}}}}$', '')) AS dup_key,
           '{AS_OF}' AS extract_ts, {NO_TEXT} AS source_file,
           coalesce(json_extract_string(r.picking_id, '$[1]'), {text('r.reference')}) AS movement_ref,
           {record(MOVE_LINE)}, coalesce(json_extract_string(r.picking_id, '$[1]'), {text('r.reference')}) AS p_movement_ref
    FROM {{line_raw}} r LEFT JOIN {{priced_product}} p ON p.id = {rid('r.product_id')}
    WHERE r.state = 'done' AND r.write_date > '1999-07-16 00:00:00'""")
def whole_move_lines(t):
    """The last 900 days; which of two copies is flagged is not compared here, as copies may differ in nothing."""
    staged = mv.stg_move_line(mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=900), AS_OF)
    raw = t.line_raw.withColumn("movement_ref", F.lit("x"))
    return opened(staged.drop("dup_flag"), raw, F.get_json_object("payload", "$.raw"))


WHOLE_ENTRIES = ENTRIES_SQL.replace(
    "AS movement_day, move_line_id, side, loc AS location_id,",
    "AS movement_day, move_line_id, move_id, picking_id, uom_name, barcode, unit_sale_price, coalesce(unit_cost, 0) AS unit_cost, side, loc AS location_id,",
).replace(
    "SELECT movement_day || '' AS movement_day, move_line_id,",
    f"""SELECT md5(CAST(movement_day AS STRING) || '|' || CAST(move_line_id AS STRING) || '|' || side || '|' || CAST(location_id AS STRING)) AS movement_id,
           move_id, picking_id, CAST(write_ts AS STRING) AS write_date, uom_name, '{AS_OF}' AS loaded_at, barcode, CAST(unit_sale_price AS DOUBLE) AS unit_sale_price,
           CAST(unit_cost AS DOUBLE) AS unit_cost, movement_day || '' AS movement_day, move_line_id,""")


@query("ds_08_whole_fact", WHOLE_ENTRIES)
def whole_fact(t):
    return mv.fct_stock_movement(t.staged, t.location, rules(t), AS_OF)


@query("ds_03_whole_dimension", PRODUCT_SQL.replace("SELECT p_partkey AS product_id,", """SELECT md5(CAST(p_partkey AS STRING)) AS product_key, active,
           true AS is_current, r.name AS name_raw, p_partkey AS product_id,"""))
def whole_product_dimension(t):
    changed = dim.changed_products(
        t.product_raw, t.template_raw, t.unit_raw, t.category_raw, "2024-01-05 08:00:00", 1 << 60, AS_OF, keywords=PART_KEYWORDS,
    )
    return dim.dim_product(changed, dim.dim_product(changed.unionByName(changed)))


# products by what they are, whenever written; the new versions are all after the start
_ANY_TIME = PRODUCT_SQL.replace("AND write_date > '2024-01-05 08:00:00'", "")
_VERSIONS = f"""SELECT product_id, r.name || CASE n WHEN 2 THEN ' new' ELSE '' END AS name_raw, CASE n WHEN 2 THEN '2024-02-01 00:00:00' ELSE updated_at END AS updated_at,
      CAST(CASE WHEN product_id % 3 = 0 AND updated_at > '2024-01-05 08:00:00' THEN 2 ELSE 1 END AS BIGINT) AS times
    FROM ({_ANY_TIME}) JOIN {{product_raw}} r ON r.id = product_id CROSS JOIN (SELECT unnest([1, 2]) AS n)
    WHERE (n = 1 AND updated_at > '2024-01-05 08:00:00') OR (n = 2 AND product_id % 3 = 0)"""


@query("ds_03_audit_files", f"""
    SELECT 'touched' AS file, product_id, name_raw, updated_at, CAST(NULL AS BIGINT) AS occurrences FROM ({_VERSIONS}) UNION ALL
    SELECT 'duplicates', product_id, name_raw, updated_at, times FROM ({_VERSIONS}) WHERE times = 2""")
def audit_files(t):
    """A third of the products come in two versions; both audits are written as files and read back."""
    newer = t.product_raw.filter("id % 3 = 0").withColumns({"name": F.concat("name", F.lit(" new")), "write_date": F.lit("2024-02-01 00:00:00")})
    loaded = dim.load_products(
        t.product_raw.unionByName(newer), t.template_raw, t.unit_raw, t.category_raw, "2024-01-05 08:00:00", 1 << 60, AS_OF, keywords=PART_KEYWORDS,
    )
    out = []
    for kind in ("touched", "duplicates"):
        path = scratch_path(t.spark, kind)
        files.write_audit(loaded[kind], path, "updated_at", "product_id")
        schema = loaded[kind].select("product_id", "updated_at", *[c for c in loaded[kind].columns if c not in ("product_id", "updated_at")]).schema
        out.append(t.spark.read.schema(schema).option("header", True).csv(path).withColumn("file", F.lit(kind)))
    out[0] = out[0].withColumn("occurrences", F.lit(None).cast("bigint"))
    columns = ["file", "product_id", "name_raw", "updated_at", "occurrences"]
    return out[0].select(columns).unionByName(out[1].select(columns))


@query("ds_04_whole_dimension", """
    SELECT md5(CAST(id AS STRING)) AS location_key, id AS location_id, CASE WHEN id % 11 = 0 THEN name ELSE trim(complete_name) END AS complete_name,
           CASE WHEN usage = 'false' THEN 'internal' ELSE trim(usage) END AS usage, b.site_norm, b.name_norm,
           CASE WHEN location_id <> 'false' THEN CAST(json_extract_string(location_id, '$[0]') AS BIGINT) END AS parent_id,
           coalesce(active, true) AS is_current, CASE WHEN id % 2 = 0 THEN '2001-01-01 00:00:00' ELSE '2002-01-01 00:00:00' END AS created_at, '2002-01-01 00:00:00' AS updated_at
    FROM {location_raw} JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 'OTHER' ELSE CASE s_suppkey % 3 WHEN 0 THEN 'DEPOT_CENTRAL' WHEN 1 THEN 'BOUTIQUE' ELSE 'OTHER' END END AS site_norm,
           CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE CASE s_suppkey % 3 WHEN 0 THEN 'DEPOT | CENTRAL | ' WHEN 1 THEN 'BOUTIQUE | ' ELSE 'PARTNER | ' END END || upper(s_name) AS name_norm
           FROM supplier) b ON b.s_suppkey = id""")
def whole_location_dimension(t):
    """Locations with an even id were there before."""
    old = dim.dim_location(t.location_raw.filter("id % 2 = 0").withColumn("usage", F.lit("transit")), "2001-01-01 00:00:00")
    return dim.dim_location(t.location_raw, AS_OF, old)


@query("ds_11_whole_lines", f"""
    SELECT r.id AS line_id, {rid('r.order_id')} AS order_id, {rid('r.product_id')} AS product_id, {money('r.qty')} AS qty, {money('r.price_unit')} AS price_unit,
           {money('r.discount')} AS discount_percent, {money('r.price_subtotal_incl')} AS subtotal_incl_tax, r.create_date AS created_at,
           coalesce(o.name, 'INCONNU') AS pos_reference, '{AS_OF}' AS ingested_at
    FROM {{order_line_raw}} r LEFT JOIN {{order_raw}} o ON o.id = {rid('r.order_id')} WHERE r.create_date >= '1996-01-01 00:00:00'""")
def whole_staged_lines(t):
    return staged_lines(t)["lines"]


ORDER = "id name pos_reference uuid session_id config_id date_order write_date employee_id partner_id amount_tax amount_total amount_paid state"


def order_sql(where: str, missing: str, reference: str, stamp: str) -> str:
    return f"""
    SELECT r.id AS order_id, {missing.format(rid('r.session_id'))} AS session_id, {missing.format(rid('r.config_id'))} AS config_id, r.write_date AS txn_ts,
           r.write_date[1:10] AS txn_day, {rid('r.employee_id')} AS employee_id, CAST(NULL AS BIGINT) AS partner_id, {money('r.amount_tax')} AS amount_tax,
           {money('r.amount_total')} AS amount_total, {money('r.amount_paid')} AS amount_paid, CAST(0 AS DOUBLE) AS amount_return, r.state,
           {reference} AS pos_reference, {NO_TEXT} AS uuid, r.write_date AS write_ts, '{AS_OF}' AS {stamp}, {record(ORDER)}, CAST(0 AS DOUBLE) AS p_amount_return
    FROM {{order_raw}} r WHERE {where}"""


@query("ds_12_whole_orders", f"WITH {HIST_KEYS}" + order_sql(
    "r.id IN (SELECT k FROM keys)", "coalesce({}, 0)", f"coalesce({text('r.pos_reference')}, {text('r.name')})", "ingested_at"))
def whole_history_orders(t):
    return opened(history(t)["orders"], t.order_raw)


PAYMENT = "id pos_order_id payment_method_id payment_date create_date write_date is_change"


@query("ds_12_whole_payments", f"""
    WITH {HIST_KEYS}, paid AS (SELECT *, CASE WHEN abs(amount) >= 1e9 THEN amount / 1e9 ELSE amount END AS price FROM {{payment_raw}})
    SELECT r.id AS payment_id, {rid('r.pos_order_id')} AS order_id, r.write_date AS payment_ts, r.write_date[1:10] AS payment_day,
           {rid('r.payment_method_id')} AS method_id, {money('round(r.price, 2)')} AS amount, r.write_date AS write_ts, '{AS_OF}' AS ingested_at,
           {record(PAYMENT)}, round(r.price, 2) AS p_amount
    FROM paid r WHERE {rid('r.pos_order_id')} IN (SELECT k FROM keys)""")
def whole_history_payments(t):
    loaded = pos.pos_hist(t.order_raw, t.order_line_raw, exact_payments(t), *HIST, AS_OF)
    return opened(loaded["payments"], t.payment_raw)


EARLY = (datetime(1994, 1, 1), datetime(1997, 1, 1), "1997-01-01 00:00:00")
EARLY_KEYS = HIST_KEYS.replace("keys AS", "early AS").replace("1996-01-01", "1994-01-01").replace("2000-01-01", "1997-01-01")


def history_over_an_earlier_one(t):
    """The years to 1997 are stored with other states and amounts; the years from 1996 are loaded over them in one pass."""
    paid = t.numbered_payment_raw.withColumn("create_date", F.lit("false"))
    first = pos.pos_hist(t.order_raw, t.order_line_raw, paid, *EARLY)
    stale = {
        "orders": cut_lineage(first["orders"].withColumn("state", F.lit("old"))),
        "payments": cut_lineage(first["payments"].withColumn("amount", F.lit(-1).cast("decimal(16,4)"))),
    }
    return pos.load_pos_hist(t.order_raw, t.order_line_raw, paid, *HIST, AS_OF, targets=stale)


@query("ds_12_orders_over_earlier_ones", f"""
    WITH {HIST_KEYS}, {EARLY_KEYS}
    SELECT r.id AS order_id, CASE WHEN keys.k IS NULL THEN 'old' ELSE r.state END AS state, {money('r.amount_total')} AS amount_total, r.write_date AS write_ts,
           CASE WHEN keys.k IS NULL THEN '{EARLY[2]}' ELSE '{AS_OF}' END AS ingested_at
    FROM {{order_raw}} r LEFT JOIN keys ON keys.k = r.id LEFT JOIN early ON early.k = r.id WHERE keys.k IS NOT NULL OR early.k IS NOT NULL""")
def history_orders_over_earlier_ones(t):
    return history_over_an_earlier_one(t)["orders"].select("order_id", "state", "amount_total", "write_ts", "ingested_at")


@query("ds_12_payments_over_earlier_ones", f"""
    WITH {HIST_KEYS}, {EARLY_KEYS}
    SELECT r.id AS payment_id, {rid('r.pos_order_id')} AS order_id, {rid('r.payment_method_id')} AS method_id,
           CASE WHEN keys.k IS NULL THEN -1 ELSE {money('r.amount')} END AS amount, r.write_date AS payment_ts,
           CASE WHEN keys.k IS NULL THEN '{EARLY[2]}' ELSE '{AS_OF}' END AS ingested_at
    FROM {{numbered_payment_raw}} r LEFT JOIN keys ON keys.k = {rid('r.pos_order_id')} LEFT JOIN early ON early.k = {rid('r.pos_order_id')}
    WHERE keys.k IS NOT NULL OR early.k IS NOT NULL""")
def history_payments_over_earlier_ones(t):
    return history_over_an_earlier_one(t)["payments"].select("payment_id", "order_id", "method_id", "amount", "payment_ts", "ingested_at")


@query("ds_11_payment_texts_over_earlier_ones")
def payment_texts_over_earlier_ones(t):
    """Texts of half the orders are stored as old ones, and as those of orders that do not come again."""
    loaded = staged_lines(t)
    half = loaded["payment_texts"].filter("order_id % 2 = 0").withColumn("payment_text", F.lit("old"))
    stale = cut_lineage(half.unionByName(half.withColumn("order_id", F.col("order_id") + 10**12)))
    hours = int((datetime(2002, 1, 1) - datetime(1996, 1, 1)).total_seconds() // 3600)
    targets = {"lines": cut_lineage(loaded["lines"].limit(0)), "payment_texts": stale}
    return pos.stg_pos_line(t.order_line_raw, t.order_raw, exact_payments(t), AS_OF, targets, hours)["payment_texts"]


_TEXTS = QUERIES["ds_11_pos_payment_texts"][1]
QUERIES["ds_11_payment_texts_over_earlier_ones"] = (
    QUERIES["ds_11_payment_texts_over_earlier_ones"][0],
    f"SELECT * FROM ({_TEXTS}) UNION ALL SELECT order_id + 1000000000000, part, 'old' FROM ({_TEXTS}) WHERE order_id % 2 = 0",
)


@query("ds_13_whole_orders", order_sql("r.state <> 'F'", "{}", text("r.pos_reference"), "loaded_at"))
def whole_order_fact(t):
    return opened(facts(t)["orders"], t.order_raw)


LINE = "id order_id product_id qty price_unit discount price_subtotal price_subtotal_incl create_date write_date"


@query("ds_13_whole_lines", f"""
    SELECT r.id AS line_id, o.id AS order_id, {rid('o.config_id')} AS config_id, o.write_date AS txn_ts, o.write_date[1:10] AS txn_day,
           p.product_id, p.barcode, {money('r.qty')} AS qty, {money('r.price_unit')} AS unit_price, {money('r.discount')} AS discount_percent,
           {money('r.price_subtotal')} AS subtotal_excl_tax, {money('r.price_subtotal_incl')} AS subtotal_incl_tax, r.write_date AS write_ts,
           '{AS_OF}' AS loaded_at, {record(LINE)}
    FROM {{order_line_raw}} r JOIN {{order_raw}} o ON o.id = {rid('r.order_id')} JOIN {{product}} p ON p.product_id = {rid('r.product_id')} WHERE o.state <> 'F'""")
def whole_line_fact(t):
    return opened(facts(t)["lines"], t.order_line_raw)


@query("ds_13_whole_sessions", f"""
    SELECT r.id AS session_id, {rid('r.config_id')} AS config_id, r.start_at AS start_ts, {NO_TEXT} AS stop_ts, r.state, '{AS_OF}' AS loaded_at,
           {record('id config_id start_at stop_at state write_date')}
    FROM {{session_raw}} r WHERE CAST(r.write_date AS TIMESTAMP) >= TIMESTAMP '2002-01-01' - INTERVAL 2000 DAYS""")
def whole_session_fact(t):
    return opened(pos.fct_pos_session(t.session_raw, AS_OF, days=2000), t.session_raw)


@query("ds_13_payments_over_earlier_ones", f"""
    WITH made AS (SELECT r.*, o.id AS order_id, o.config_id AS shop, o.write_date AS ordered FROM {{numbered_payment_raw}} r JOIN {{order_raw}} o ON o.id = {rid('r.pos_order_id')}
         WHERE o.state <> 'F'),
    start AS (SELECT CAST(max(CAST(write_date AS TIMESTAMP)) - INTERVAL 400 DAYS AS STRING) AS since_ts FROM made WHERE write_date < '1999-01-01')
    SELECT r.id AS payment_id, r.order_id, {rid('r.shop')} AS config_id, {rid('r.payment_method_id')} AS method_id,
           CASE WHEN r.write_date < since_ts THEN -1 ELSE {money('r.amount')} END AS amount, r.is_change, r.write_date AS write_ts, '{AS_OF}' AS loaded_at,
           CASE WHEN r.payment_date = 'false' THEN r.ordered[1:10] || ' 00:00:00' ELSE r.payment_date END AS payment_ts,
           CASE WHEN r.payment_date = 'false' THEN r.ordered[1:10] ELSE r.payment_date[1:10] END AS payment_day,
           {record(PAYMENT.replace(' create_date', '') + ' amount')}
    FROM made r, start""")
def payments_over_earlier_ones(t):
    """Payments up to 1999 are stored with other amounts; the load starts 400 days before the latest of them, so that older
    ones keep theirs."""
    paid, sources = t.numbered_payment_raw, (t.order_line_raw, t.session_raw, t.product, AS_OF)
    first = pos.fct_pos(t.order_raw, sources[0], paid, *sources[1:])["payments"].filter(F.col("write_ts") < "1999-01-01")
    stale = cut_lineage(first.withColumn("amount", F.lit(-1).cast("decimal(16,4)")))
    again = pos.fct_pos(t.order_raw, sources[0], paid, *sources[1:], targets={"payments": stale}, buffer="INTERVAL 400 DAYS")
    return opened(again["payments"], paid)


@query("ds_13_sessions_over_earlier_ones", f"""
    SELECT r.id AS session_id, {rid('r.config_id')} AS config_id, r.start_at AS start_ts, {NO_TEXT} AS stop_ts,
           CASE WHEN r.write_date >= '1997-12-02' THEN r.state ELSE 'old' END AS state, '1998-01-01 00:00:00' AS loaded_at
    FROM {{session_raw}} r WHERE r.write_date >= '1997-12-02' OR (r.id % 2 = 0 AND r.write_date >= '1996-01-12')""")
def sessions_over_earlier_ones(t):
    """Half the sessions are stored as old; those of the last thirty days are loaded over them."""
    stored = pos.fct_pos_session(t.session_raw, "1998-01-01 00:00:00", days=720).filter("session_id % 2 = 0").withColumn("state", F.lit("old"))
    loaded = pos.fct_pos(
        t.order_raw, t.order_line_raw, t.numbered_payment_raw, t.session_raw, t.product, "1998-01-01 00:00:00", targets={"sessions": cut_lineage(stored)},
    )
    return loaded["sessions"].drop("payload")


EXPENSE = "id date employee_id name total_amount state write_date create_date"


@query("ds_14_whole_expenses", f"""
    SELECT r.id AS expense_id, {text('r.date')} AS expense_date, json_extract_string(r.employee_id, '$[1]') AS employee_name,
           CASE WHEN r.write_date <= '1998-01-01 00:00:00' THEN -1 ELSE {money('r.total_amount')} END AS total_amount, r.state AS status,
           r.write_date AS write_ts, r.create_date AS create_ts, CASE WHEN r.write_date <= '1998-01-01 00:00:00' THEN '2000-01-01 00:00:00' ELSE '{AS_OF}' END AS updated_at,
           {record(EXPENSE)}
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY write_date DESC, employee_id DESC, total_amount DESC, state DESC) AS rn FROM {{expense_raw}}) r
    WHERE rn = 1""")
def whole_expenses(t):
    raw = latest_expenses(t)
    return opened(ex.load_expenses(old_expenses(t, raw), raw, AS_OF, "1998-01-01 00:00:00"), t.expense_raw)


QUANT = "id write_date create_date product_id location_id company_id lot_id quantity reserved_quantity in_date"


@query("ds_15_quants_over_earlier_ones", f"""
    SELECT r.write_date[1:10] AS part_day, r.id AS quant_id, r.write_date AS written_at, {NO_TEXT} AS created_at, {rid('r.product_id')} AS product_id,
           {rid('r.location_id')} AS location_id, CAST(1 AS BIGINT) AS company_id, CAST(NULL AS BIGINT) AS lot_id,
           CASE WHEN r.write_date > '1998-01-01 00:00:00' OR (r.write_date = '1998-01-01 00:00:00' AND r.id > 5000) THEN {money('r.quantity')} ELSE -1 END AS quantity,
           {money('r.reserved_quantity')} AS reserved_quantity, {text('r.in_date')} AS in_date, {record(QUANT)}
    FROM {{numbered_quant_raw}} r JOIN {{location}} l ON l.location_id = {rid('r.location_id')} WHERE l.usage IN ('internal', 'inventory')""")
def quants_over_earlier_ones(t):
    """Quants up to 1999 are stored with other quantities; those written since 1998 are loaded over them."""
    raw = t.numbered_quant_raw
    before = stock.stg_quant(raw.filter("write_date < '1999-01-01'"), t.location, "1990-01-01 00:00:00", 0, AS_OF)
    stale = cut_lineage(before.withColumn("quantity", F.lit(-1).cast("decimal(16,4)")))
    return opened(stock.load_quants(raw, t.location, "1998-01-01 00:00:00", 5000, AS_OF, stale)["quants"], raw)
