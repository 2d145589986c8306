"""Composed datasets, and the report that needs the order facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.q_relational import RULES_SQL, WHOLE, rules
from checks.q_sources import EXTRACT_SQL, extract_columns
from checks.registry import query
from checks.standins import PAYMENT_ID
from comptoir.functions.records import m2o_id, parse_dt
from comptoir.operators import merge as mg
from comptoir.operators.windows import dedup_latest
from comptoir.plans import dimensions as dim
from comptoir.plans import expenses as ex
from comptoir.plans import movements as mv
from comptoir.plans import pos, stock
from comptoir.plans import reports as rp
from comptoir.session import cut_lineage, scratch_path

AS_OF = "2002-01-01 00:00:00"
PART_KEYWORDS = ("PERRUQUE", "LACE", "CLOSURE", "PLANTE")


@query("ds_01_employee_dimension", f"""
    SELECT c_custkey AS employee_id, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN lower(c_name) || '@mail' END AS work_email,
           CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS job_title, 'Dept, ' || CAST(c_nationkey AS STRING) AS department,
           c_acctbal > 0 AS active, '{AS_OF}' AS updated_at FROM customer""")
def employee_dimension(t):
    old = dim.dim_employee(t.employee_raw.withColumn("name", F.lit("old")), "2001-01-01 00:00:00")
    return dim.dim_employee(t.employee_raw, AS_OF, old)


@query("ds_02_shop_dimension", f"""
    SELECT s_suppkey AS shop_id, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE s_name END AS name,
           CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_nationkey END AS company_id,
           s_suppkey % 5 = 0 OR s_acctbal > 0 AS is_active, true AS is_current,
           CASE WHEN s_acctbal > 5000 THEN '2001-01-01 00:00:00' ELSE '{AS_OF}' END AS created_at, '{AS_OF}' AS updated_at FROM supplier""")
def shop_dimension(t):
    rich = t.supplier.filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("id"))
    old = dim.dim_shop(t.shop_raw.join(rich, "id", "left_semi"), "2001-01-01 00:00:00")
    return dim.dim_shop(t.shop_raw, AS_OF, old)


PRODUCT_SQL = """
    WITH RECURSIVE cat AS (SELECT id, trim(name) AS name, CASE WHEN id < 4 THEN NULL ELSE id // 2 END AS parent FROM {category_raw}),
    walk AS (SELECT id, parent, name AS path FROM cat UNION ALL
             SELECT w.id, c.parent, c.name || ' / ' || w.path FROM walk w JOIN cat c ON c.id = w.parent),
    paths AS (SELECT id, max_by(path, length(path)) AS path FROM walk GROUP BY 1)
    SELECT p_partkey AS product_id, 'VENTE / ' || CASE WHEN upper(path) LIKE '%PERRUQUE%' THEN 'PERRUQUE' WHEN upper(path) LIKE '%LACE%' THEN 'LACE'
             WHEN upper(path) LIKE '%CLOSURE%' THEN 'CLOSURE' END AS category_norm,
           upper(p_name) AS name_norm, path AS category_raw, CASE p_size % 6 WHEN 2 THEN 'Box' ELSE 'Units' END AS uom,
           '2024-01-01 00:00:00' AS created_at, write_date AS updated_at, b.barcode
    FROM part JOIN {product_raw} r ON r.id = p_partkey JOIN paths ON paths.id = p_size
    JOIN (SELECT product_id, barcode FROM {product}) b ON b.product_id = p_partkey
    WHERE p_size > 2 AND b.barcode <> 'false' AND p_partkey % 17 <> 0 AND write_date > '2024-01-05 08:00:00'
          AND regexp_matches(upper(path), 'PERRUQUE|LACE|CLOSURE|PLANTE')"""


@query("ds_03_product_dimension", PRODUCT_SQL)
def product_dimension(t):
    since = "2024-01-05 08:00:00"
    changed = dim.changed_products(
        t.product_raw, t.template_raw, t.unit_raw, t.category_raw, since, 1 << 60, AS_OF, keywords=PART_KEYWORDS
    )
    new = dim.dim_product(changed.unionByName(changed))
    # loaded again over itself without barcodes, which may not erase them
    again = dim.dim_product(changed.withColumn("barcode", F.lit(None).cast("string")), new)
    return again.select(
        "product_id", "category_norm", "name_norm", "category_raw", "uom", "created_at", "updated_at", "barcode"
    )


def product_load(t):
    return dim.load_products(
        t.product_raw, t.template_raw, t.unit_raw, t.category_raw, "2024-01-05 08:00:00", 1 << 60, AS_OF, keywords=PART_KEYWORDS
    )


@query("ds_03_product_watermark", """
    SELECT write_date AS watermark_ts, id AS watermark_id FROM {product_raw}
    WHERE active AND barcode IS NOT NULL AND barcode <> 'false' AND write_date > '2024-01-05 08:00:00' ORDER BY write_date DESC, id DESC LIMIT 1""")
def product_watermark(t):
    return product_load(t)["watermark"]


@query("ds_04_location_dimension", """
    SELECT s_suppkey AS location_id, full_name AS complete_name,
           CASE s_suppkey % 5 WHEN 0 THEN 'internal' WHEN 1 THEN 'customer' WHEN 2 THEN 'supplier' WHEN 3 THEN 'inventory' ELSE 'internal' END AS usage,
           CASE WHEN upper(full_name) LIKE 'DEPOT/CENTRAL%' THEN 'DEPOT_CENTRAL' WHEN upper(full_name) LIKE 'BOUTIQUE%' THEN 'BOUTIQUE' ELSE 'OTHER' END AS site_norm,
           replace(upper(full_name), '/', ' | ') AS name_norm,
           CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END AS parent_id, s_suppkey % 6 = 0 OR s_acctbal > 0 AS is_current
    FROM (SELECT *, CASE WHEN s_suppkey % 11 = 0 THEN s_name ELSE CASE s_suppkey % 3 WHEN 0 THEN 'Depot/Central/' WHEN 1 THEN 'Boutique/'
          ELSE 'Partner/' END || s_name END AS full_name FROM supplier)""")
def location_dimension(t):
    old = dim.dim_location(t.location_raw.withColumn("usage", F.lit("transit")), "2001-01-01 00:00:00")
    return dim.dim_location(t.location_raw, AS_OF, old).select(
        "location_id", "complete_name", "usage", "site_norm", "name_norm", "parent_id", "is_current"
    )


@query("ds_05_payment_method_dimension", f"""
    SELECT c_custkey AS method_id, c_name AS name, CASE WHEN listed AND c_custkey % 4 <> 0 THEN c_nationkey END AS journal_id,
           CASE WHEN listed AND c_custkey % 4 <> 0 THEN coalesce(CASE WHEN n_nationkey % 5 <> 0 AND n_regionkey < 4 THEN n_name END, 'own') END AS journal_name,
           CASE WHEN listed AND c_custkey % 4 <> 0 AND n_regionkey < 4 THEN 'cash' END AS journal_type,
           listed AND (c_custkey % 6 = 0 OR c_acctbal > 0) AS is_current,
           '2001-01-01 00:00:00' AS created_at, CASE WHEN listed OR NOT (c_custkey % 6 = 0 OR c_acctbal > 0) THEN '2024-01-02 03:04:05' ELSE '{AS_OF}' END AS updated_at
    FROM (SELECT *, c_mktsegment <> 'HOUSEHOLD' AS listed FROM customer) JOIN nation ON n_nationkey = c_nationkey""")
def payment_method_dimension(t):
    """All methods were loaded without journals; those of one segment are gone since."""
    methods = t.method_raw
    old = dim.dim_payment_method(methods.drop("cash_journal_id"), t.journal_raw, "2001-01-01 00:00:00")
    listed = t.customer.filter("c_mktsegment <> 'HOUSEHOLD'").select(F.col("c_custkey").alias("id"))
    return dim.dim_payment_method(methods.join(listed, "id", "left_semi"), t.journal_raw, AS_OF, old)


@query("ds_06_move_line_extract", EXTRACT_SQL)
def move_line_extract(t):
    since = datetime(1994, 1, 1)
    lines = mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=(datetime(2002, 1, 1) - since).days)
    return extract_columns(lines)


STAGED_SQL = """
    SELECT odoo_id AS move_line_id, product_id, location_dest_id, write_date[1:10] AS part_day, write_date AS write_ts, CAST(qty AS DOUBLE) AS qty_done,
           CASE WHEN barcode <> 'false' THEN barcode END AS barcode, unit_sale_price, unit_cost, ref AS movement_ref,
           md5(CAST(odoo_id AS STRING) || '|' || write_date || '|' || regexp_replace(CAST(CAST(qty AS DECIMAL(20,4)) AS STRING), '0{{1,3}}$', '')) AS dup_key
    FROM (""" + EXTRACT_SQL + ")"


@query("ds_07_move_line_staging", STAGED_SQL)
def move_line_staging(t):
    extract = mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=2922)
    return mv.stg_move_line(extract, AS_OF).select(
        "move_line_id", "product_id", "location_dest_id", "part_day", "write_ts", "qty_done", "barcode",
        "unit_sale_price", "unit_cost", "movement_ref", "dup_key",
    )


@query("ds_07_stored_by_day", STAGED_SQL)
def move_lines_by_day(t):
    """An earlier load had other days from the cut on; the reload takes their place, read back from the table."""
    extract = mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=2922)
    staged = cut_lineage(mv.stg_move_line(extract, AS_OF))
    path, cut = scratch_path(t.spark, "staging"), "1998-01-01"
    moved = F.when(F.col("part_day") >= cut, F.date_add("part_day", 9000)).otherwise(F.col("part_day"))
    mg.overwrite_parts(staged.withColumn("part_day", moved), path, "part_day", in_turn=True)
    mv.store_move_lines(staged, path, cut)
    return t.spark.read.schema(staged.schema).parquet(path).select(
        "move_line_id", "product_id", "location_dest_id", "part_day", "write_ts", "qty_done", "barcode",
        "unit_sale_price", "unit_cost", "movement_ref", "dup_key",
    )


ENTRIES_SQL = f"""
    WITH moves AS (SELECT coalesce(write_ts, business_ts) AS moved_at, s.*, coalesce(movement_ref,
               CASE WHEN move_line_id % 8 <> 1 THEN 'PICK/' || CAST(move_id AS STRING) END) AS ref
             FROM {{staged}} s WHERE coalesce(state, '') = 'done'),
    typed AS (SELECT ref AS tref, min_by(code, priority * 1000 + rank) AS code FROM (SELECT DISTINCT ref FROM moves WHERE ref IS NOT NULL)
         JOIN (SELECT *, row_number() OVER (ORDER BY code) AS rank FROM {RULES_SQL} WHERE is_active) x ON ref LIKE x.pattern GROUP BY 1),
    sides AS (SELECT *, 'SRC' AS side, location_id AS loc FROM moves UNION ALL SELECT *, 'DST', location_dest_id FROM moves),
    entries AS (SELECT CAST(moved_at AS DATE) AS movement_day, move_line_id, side, loc AS location_id, product_id, write_ts, abs(qty_done) AS qty,
           CASE WHEN l.usage = 'internal' THEN CASE WHEN side = 'SRC' THEN -abs(qty_done) ELSE abs(qty_done) END ELSE 0 END AS signed_qty,
           l.usage AS location_usage, coalesce(l.usage = 'internal', false) AS is_internal,
           year(moved_at) * 10000 + month(moved_at) * 100 + day(moved_at) AS date_key,
           CAST(abs(qty_done) * unit_sale_price AS DECIMAL(18,4)) AS value_sale,
           CAST(abs(qty_done) * coalesce(unit_cost, 0) AS DECIMAL(18,4)) AS value_cost, ref AS movement_ref, code AS movement_type
         FROM sides s LEFT JOIN {{location}} l ON l.location_id = s.loc LEFT JOIN typed ON tref = ref)
    SELECT movement_day || '' AS movement_day, move_line_id, side, location_id, product_id, CAST(qty AS DOUBLE) AS qty,
           CAST(signed_qty AS DOUBLE) AS signed_qty, location_usage, is_internal, date_key, CAST(value_sale AS DOUBLE) AS value_sale,
           CAST(value_cost AS DOUBLE) AS value_cost, movement_ref, movement_type FROM entries"""
ENTRY_COLUMNS = [
    "movement_day", "move_line_id", "side", "location_id", "product_id", "qty", "signed_qty", "location_usage",
    "is_internal", "date_key", "value_sale", "value_cost", "movement_ref", "movement_type",
]


@query("ds_08_stock_movement_fact", ENTRIES_SQL)
def stock_movement_fact(t):
    return mv.fct_stock_movement(t.staged, t.location, rules(t), AS_OF).select(*ENTRY_COLUMNS)


@query("ds_08_stock_movement_merge", ENTRIES_SQL.replace("FROM entries", """FROM (
      SELECT *, row_number() OVER (PARTITION BY movement_day, move_line_id, side, location_id
             ORDER BY write_ts DESC NULLS LAST, product_id DESC, qty DESC) AS rn FROM entries) WHERE rn = 1"""))
def stock_movement_merge(t):
    """The fact loaded up to 1999 with zero quantities, then merged with everything."""
    before = mv.latest_entries(mv.fct_stock_movement(t.staged, t.location, rules(t), "2000-01-01 00:00:00", to_day="1999-12-31"))
    stale = cut_lineage(before.withColumn("qty", F.lit(0).cast("decimal(16,4)")))
    return mv.fct_stock_movement(t.staged, t.location, rules(t), AS_OF, target=stale).select(*ENTRY_COLUMNS)


@query("ds_09_stock_opening", """
    SELECT '2001-12-31' AS opening_date, l_partkey AS product_id, l_suppkey AS location_id, l_quantity AS opening_qty,
           CAST(cost AS DOUBLE) AS unit_cost, CAST(price AS DOUBLE) AS unit_sale_price,
           CAST(CAST(CAST(l_quantity AS DECIMAL(16,4)) * cost AS DECIMAL(18,4)) AS DOUBLE) AS value_cost,
           CAST(CAST(CAST(l_quantity AS DECIMAL(16,4)) * price AS DECIMAL(18,4)) AS DOUBLE) AS value_sale,
           CASE WHEN l_returnflag = 'R' THEN '2001-12-31' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS in_date
    FROM lineitem JOIN {product} p ON p.product_id = l_partkey JOIN {location} l ON l.location_id = l_suppkey
    WHERE l_partkey % 19 <> 0 AND l.usage = 'internal' AND l_suppkey NOT IN (8, 16) AND sale_ok
          AND regexp_matches(lower(name_raw), 'small|ring|bolt') AND NOT starts_with(lower(name_raw), 'brand#2')""")
def stock_opening(t):
    quants = t.quant_raw.select(
        m2o_id("product_id").alias("product_id"), m2o_id("location_id").alias("location_id"), "quantity",
        parse_dt("in_date").alias("in_date"),
    )
    products = t.product.select(
        "product_id", F.col("name_raw").alias("display_name"), "sale_ok",
        F.col("cost").alias("standard_price"), F.col("price").alias("lst_price"),
    )
    return stock.fct_stock_opening(
        quants, t.location, products, "2001-12-31", excluded_locations=[8, 16],
        keywords=("small", "ring", "bolt"), untracked=("brand#2",),
    )


@query("ds_10_ledger", """
    SELECT year(opening_date) * 10000 + month(opening_date) * 100 + day(opening_date) AS date_key, opening_date || '' AS day, location_id, barcode,
           CAST(opening_qty AS DOUBLE) AS qty, CAST(opening_qty AS DOUBLE) AS signed_qty, CAST(unit_cost AS DOUBLE) AS unit_cost,
           CAST(unit_sale_price AS DOUBLE) AS unit_sale_price, 'OPENING' AS movement_type, 'INITIAL' AS source_type, CAST(NULL AS BIGINT) AS move_line_id
    FROM {opening} o LEFT JOIN {product} p ON p.product_id = o.product_id UNION ALL
    SELECT date_key, movement_day || '', location_id, barcode, CAST(signed_qty AS DOUBLE), CAST(signed_qty AS DOUBLE), CAST(coalesce(unit_cost, 0) AS DOUBLE),
           CAST(coalesce(unit_sale_price, 0) AS DOUBLE), coalesce(movement_type, 'INCONNU'), 'ODOO_MOVE', move_line_id
    FROM {movement} WHERE barcode IS NOT NULL AND is_internal AND location_usage = 'internal'""")
def ledger(t):
    return stock.ledger(t.opening, t.movement, t.product)


PLAIN = "regexp_replace(CAST(CAST({c} AS DECIMAL(20,4)) AS STRING), '0{{{{1,3}}}}$', '')"


PAID = f"""paid AS (SELECT l_orderkey AS order_id, {PAYMENT_ID} AS id, CAST(l_linenumber AS BIGINT) AS method_id,
      CASE WHEN l_linenumber <> 6 THEN 'Pay ' || CAST(l_linenumber AS STRING) END AS method_name, l_suppkey,
      CAST(l_extendedprice AS DECIMAL(16,4)) AS amount FROM lineitem)"""


@query("ds_11_pos_line_staging", """
    SELECT l_orderkey * 8 + l_linenumber AS line_id, l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000000 ELSE 0 END AS order_id,
           l_partkey AS product_id, l_quantity AS qty, l_extendedprice AS price_unit, CAST(l_shipdate AS STRING) AS created_at,
           CASE WHEN l_linenumber = 7 THEN 'INCONNU' ELSE 'Order ' || CAST(l_orderkey AS STRING) END AS pos_reference
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'""")
def pos_line_staging(t):
    return staged_lines(t)["lines"].select(
        "line_id", "order_id", "product_id", "qty", "price_unit", "created_at", "pos_reference"
    )


@query("ds_11_pos_payment_texts", f"""
    WITH {PAID}
    SELECT order_id, 0 AS part, string_agg(part, ' | ' ORDER BY id, part) AS payment_text FROM (
         SELECT order_id, id, coalesce(method_name, 'PM_' || CAST(method_id AS STRING)) || ': ' || {PLAIN.format(c='amount')} AS part FROM paid)
    WHERE order_id IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <> 7 AND l_shipdate >= TIMESTAMP '1996-01-01 00:00:00') GROUP BY 1""")
def pos_payment_texts(t):
    return staged_lines(t)["payment_texts"]


def staged_lines(t):
    hours = int((datetime(2002, 1, 1) - datetime(1996, 1, 1)).total_seconds() // 3600)
    return pos.stg_pos_line(t.order_line_raw, t.order_raw, exact_payments(t), AS_OF, hours=hours)


def exact_payments(t):
    """The payments with the line price as amount."""
    price = F.when(F.abs("amount") >= 1e9, F.col("amount") / 1e9).otherwise(F.col("amount"))
    return t.payment_raw.withColumn("amount", F.round(price, 2))


HIST = (datetime(1996, 1, 1), datetime(2000, 1, 1))


def history(t):
    return pos.pos_hist(t.order_raw, t.order_line_raw, t.payment_raw, *HIST, AS_OF)


HIST_KEYS = """keys AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber <> 7
      AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2000-01-01')"""


@query("ds_12_pos_history_orders", f"""
    WITH {HIST_KEYS} SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE c_nationkey END AS session_id, c_nationkey AS config_id,
      CAST(o_orderdate AS STRING) AS txn_ts, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS employee_id,
      CAST(CAST(o_totalprice AS DECIMAL(16,4)) AS DOUBLE) AS amount_total,
      CASE WHEN o_orderstatus = 'P' THEN 'Order ' || CAST(o_orderkey AS STRING) ELSE 'POS/' || CAST(o_orderkey AS STRING) END AS pos_reference
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT k FROM keys)""")
def pos_history_orders(t):
    return history(t)["orders"].select("order_id", "session_id", "config_id", "txn_ts", "employee_id", "amount_total", "pos_reference")


@query("ds_12_pos_history_lines", f"""
    WITH {HIST_KEYS}, {PAID}, sums AS (SELECT order_id, CASE WHEN count(*) = 1 THEN min(method_id) END AS method_id,
        string_agg(label || ': ' || {PLAIN.format(c='amount')}, ' | ' ORDER BY method_id) AS text FROM (
          SELECT order_id, method_id, coalesce(max(method_name), 'PM_' || CAST(method_id AS STRING)) AS label, sum(amount) AS amount
          FROM paid GROUP BY 1, 2) GROUP BY 1)
    SELECT l_orderkey * 8 + l_linenumber AS line_id, l_partkey AS product_id, method_id, text AS payment_method_name,
           CASE WHEN o_orderkey IS NOT NULL THEN CASE WHEN o_orderstatus = 'P' THEN 'Order ' ELSE 'POS/' END || CAST(o_orderkey AS STRING) END AS pos_reference
    FROM lineitem LEFT JOIN sums ON order_id = l_orderkey AND l_linenumber <> 7 LEFT JOIN orders ON o_orderkey = l_orderkey AND l_linenumber <> 7
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2000-01-01'""")
def pos_history_lines(t):
    lines = pos.pos_hist(t.order_raw, t.order_line_raw, exact_payments(t), *HIST, AS_OF)["lines"]
    return lines.select("line_id", "product_id", "method_id", "payment_method_name", "pos_reference")


@query("ds_12_pos_history_payments", f"""
    WITH {HIST_KEYS} SELECT {PAYMENT_ID} AS payment_id, l_partkey, CAST(l_linenumber AS BIGINT) AS method_id,
           CAST(l_shipdate AS STRING) AS payment_ts, l_extendedprice * 1000000000.0 < 1e12 OR l_suppkey <> 3 AS fits
    FROM lineitem WHERE l_orderkey IN (SELECT k FROM keys)""".replace("l_partkey, ", ""))
def pos_history_payments(t):
    loaded = history(t)
    kept = loaded["payments"].select("payment_id", "method_id", "payment_ts", F.lit(True).alias("fits"))
    paid_at = F.coalesce(parse_dt("payment_date"), parse_dt("create_date"), parse_dt("write_date"))
    rejected = loaded["rejected_payments"].select(
        F.col("id").alias("payment_id"), "method_id", paid_at.alias("payment_ts"), F.lit(False).alias("fits")
    )
    return kept.unionByName(rejected)


def facts(t):
    return pos.fct_pos(t.order_raw, t.order_line_raw, exact_payments(t), t.session_raw, t.product, AS_OF)


@query("ds_13_pos_order_fact", """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'O' THEN c_nationkey END AS session_id, c_nationkey AS config_id,
           CAST(o_orderdate AS STRING) AS txn_ts, o_orderstatus AS state FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'""")
def pos_order_fact(t):
    return facts(t)["orders"].select("order_id", "session_id", "config_id", "txn_ts", "state")


@query("ds_13_pos_line_fact", """
    SELECT l_orderkey * 8 + l_linenumber AS line_id, l_orderkey AS order_id, c_nationkey AS config_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS txn_day,
           p.product_id, p.barcode, l_quantity AS qty, CAST(CAST(l_extendedprice * 1.25 AS DECIMAL(16,4)) AS DOUBLE) AS subtotal_incl_tax
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN {product} p ON p.product_id = l_partkey
    WHERE l_linenumber <> 7 AND o_orderstatus <> 'F'""")
def pos_line_fact(t):
    return facts(t)["lines"].select(
        "line_id", "order_id", "config_id", "txn_day", "product_id", "barcode", "qty", "subtotal_incl_tax"
    )


def once(lines):
    """Lines whose id does not repeat in the stand-in."""
    ids = lines.groupBy("id").count().filter("count = 1").select("id")
    return lines.join(ids, "id", "left_semi").select(lines.columns)


@query("ds_13_pos_lines_loaded_twice", """
    SELECT l_orderkey * 8 + l_linenumber AS line_id, l_orderkey AS order_id, c_nationkey AS config_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS txn_day,
           p.product_id, p.barcode, l_quantity AS qty, CAST(CAST(l_extendedprice * 1.25 AS DECIMAL(16,4)) AS DOUBLE) AS subtotal_incl_tax
    FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS times FROM lineitem)
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN {product} p ON p.product_id = l_partkey
    WHERE l_linenumber <> 7 AND o_orderstatus <> 'F' AND times = 1""")
def pos_lines_loaded_twice(t):
    """Half the lines without barcodes first, then all sources over them: late lines come in, barcodes are filled.

    All lines are loaded; those whose id repeats are left out of the rows compared, as versions of one time have
    no order that both engines share."""
    lines, blank = t.order_line_raw, t.product.withColumn("barcode", F.lit(None).cast("string"))
    first = pos.fct_pos(t.order_raw, lines.filter("id % 2 = 0"), exact_payments(t), t.session_raw, blank, AS_OF)
    targets = {"orders": cut_lineage(first["orders"]), "lines": cut_lineage(first["lines"].filter("line_id < 0").unionByName(first["lines"]))}
    again = pos.fct_pos(
        t.order_raw, lines, exact_payments(t), t.session_raw, t.product, AS_OF, targets=targets, buffer="INTERVAL 20000 DAYS",
    )
    ids = once(lines).select(F.col("id").alias("line_id"))
    return again["lines"].join(ids, "line_id", "left_semi").select(
        "line_id", "order_id", "config_id", "txn_day", "product_id", "barcode", "qty", "subtotal_incl_tax"
    )


@query("ds_13_pos_line_versions", """
    SELECT line_id, l_orderkey AS order_id, c_nationkey AS config_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS txn_day,
           p.product_id, p.barcode, l_quantity + CASE WHEN line_id % 3 = 0 THEN 0 ELSE 100 END AS qty,
           CAST(CAST(l_extendedprice * 1.25 AS DECIMAL(16,4)) AS DOUBLE) AS subtotal_incl_tax
    FROM {numbered_line} JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN {product} p ON p.product_id = l_partkey
    WHERE l_linenumber <> 7 AND o_orderstatus <> 'F'""")
def pos_line_versions(t):
    """All lines under ids of their own; half are stored without barcodes, then each comes in two versions, of which
    the other one is older for a third of the ids and newer for the rest."""
    lines, blank = t.numbered_line_raw, t.product.withColumn("barcode", F.lit(None).cast("string"))
    first = pos.fct_pos(t.order_raw, lines.filter("id % 2 = 0"), exact_payments(t), t.session_raw, blank, AS_OF)
    targets = {"orders": cut_lineage(first["orders"]), "lines": cut_lineage(first["lines"])}
    at = F.when(F.col("id") % 3 == 0, "1970-01-02 00:00:00").otherwise("2001-12-01 00:00:00")
    versions = lines.unionByName(lines.withColumns({"qty": F.col("qty") + 100, "write_date": at}))
    again = pos.fct_pos(
        t.order_raw, versions, exact_payments(t), t.session_raw, t.product, AS_OF, targets=targets, buffer="INTERVAL 20000 DAYS",
    )
    return again["lines"].select(
        "line_id", "order_id", "config_id", "txn_day", "product_id", "barcode", "qty", "subtotal_incl_tax"
    )


@query("ds_13_pos_payment_fact", f"""
    SELECT {PAYMENT_ID} AS payment_id, l_orderkey AS order_id, c_nationkey AS config_id, CAST(l_linenumber AS BIGINT) AS method_id,
           CAST(CASE WHEN l_returnflag = 'R' THEN date_trunc('day', o_orderdate) ELSE l_shipdate END AS STRING) AS payment_ts, l_extendedprice AS amount,
           l_returnflag = 'A' AS is_change
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'""")
def pos_payment_fact(t):
    return facts(t)["payments"].select(
        "payment_id", "order_id", "config_id", "method_id", "payment_ts", "amount", "is_change"
    )


@query("ds_13_pos_session_fact", """
    SELECT o_orderkey AS session_id, o_custkey AS config_id, CAST(o_orderdate AS STRING) AS start_ts, o_orderstatus AS state
    FROM orders WHERE o_orderdate >= TIMESTAMP '2002-01-01' - INTERVAL 2000 DAYS""")
def pos_session_fact(t):
    return pos.fct_pos_session(t.session_raw, AS_OF, days=2000).select("session_id", "config_id", "start_ts", "state")


EXPENSE_LATEST = """
    SELECT id AS expense_id, CASE WHEN date <> 'false' THEN date END AS expense_date,
           CASE WHEN employee_id <> 'false' THEN json_extract_string(employee_id, '$[1]') END AS employee_name,
           CAST(CAST(total_amount AS DECIMAL(16,4)) AS DOUBLE) AS total_amount, state AS status, write_date
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY write_date DESC, employee_id DESC, total_amount DESC, state DESC) AS rn
          FROM {expense_raw}) WHERE rn = 1"""


def latest_expenses(t):
    return dedup_latest(t.expense_raw, ["id"], "write_date", ["employee_id", "total_amount", "state"])


def old_expenses(t, raw):
    """What was stored before 1999, with other amounts."""
    loaded = ex.fct_expense(raw, "2000-01-01 00:00:00").filter(F.col("write_ts") < "1999-01-01")
    return loaded.withColumn("total_amount", F.lit(-1).cast("decimal(16,4)"))


EXPENSE_COLUMNS = ["expense_id", "expense_date", "employee_name", "total_amount", "status"]


@query("ds_14_expense_incremental", f"""
    SELECT expense_id, expense_date, employee_name, CASE WHEN write_date <= '1998-01-01 00:00:00' THEN -1 ELSE total_amount END AS total_amount, status
    FROM ({EXPENSE_LATEST})""")
def expense_incremental(t):
    raw = latest_expenses(t)
    return ex.load_expenses(old_expenses(t, raw), raw, AS_OF, "1998-01-01 00:00:00").select(*EXPENSE_COLUMNS)


@query("ds_14_expense_status_only", f"""
    SELECT expense_id, expense_date, employee_name, CASE WHEN write_date < '1999-01-01 00:00:00' THEN -1 ELSE total_amount END AS total_amount, status
    FROM ({EXPENSE_LATEST})""")
def expense_status_only(t):
    raw = latest_expenses(t)
    return ex.load_expense_status(old_expenses(t, raw), raw, AS_OF, "1998-01-01 00:00:00").select(*EXPENSE_COLUMNS)


@query("ds_14_expense_reload", f"""
    SELECT expense_id, expense_date, employee_name, CASE WHEN expense_date >= '1997-01-01' THEN total_amount ELSE -1 END AS total_amount, status
    FROM ({EXPENSE_LATEST}) WHERE write_date < '1999-01-01 00:00:00' OR expense_date >= '1997-01-01'""")
def expense_reload(t):
    raw = latest_expenses(t)
    merged, _ = ex.reload_expenses(old_expenses(t, raw), raw, AS_OF, "1997-01-01", "2001-12-31", purge=True)
    return merged.select(*EXPENSE_COLUMNS)


@query("ds_15_quant_staging", """
    SELECT quant_id, CAST(l_shipdate AS STRING) AS written_at, CAST(CAST(l_shipdate AS DATE) AS STRING) AS part_day, location_id FROM (
      SELECT l_orderkey * 8 + l_linenumber AS quant_id, l_shipdate, max(l_suppkey) AS location_id,
             row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY l_shipdate DESC) AS rn
      FROM lineitem JOIN {location} l ON l.location_id = l_suppkey WHERE l.usage IN ('internal', 'inventory')
           AND l_shipdate >= TIMESTAMP '1996-01-01' AND NOT (l_shipdate = TIMESTAMP '1996-01-01' AND l_orderkey * 8 + l_linenumber <= 100)
      GROUP BY 1, 2) WHERE rn = 1""")
def quant_staging(t):
    staged = stock.stg_quant(t.quant_raw.withColumn("z", m2o_id("location_id")), t.location, "1996-01-01 00:00:00", 100, AS_OF)
    return staged.select("quant_id", "written_at", "part_day", "location_id")


@query("ds_15_quant_watermark", """
    SELECT CAST(l_shipdate AS STRING) AS watermark_ts, l_orderkey * 8 + l_linenumber AS watermark_id
    FROM lineitem JOIN {location} l ON l.location_id = l_suppkey WHERE l.usage IN ('internal', 'inventory')
         AND l_shipdate >= TIMESTAMP '1996-01-01' AND NOT (l_shipdate = TIMESTAMP '1996-01-01' AND l_orderkey * 8 + l_linenumber <= 100)
    ORDER BY l_shipdate DESC, l_orderkey * 8 + l_linenumber DESC LIMIT 1""")
def quant_watermark(t):
    raw = t.quant_raw.withColumn("z", m2o_id("location_id"))
    return stock.load_quants(raw, t.location, "1996-01-01 00:00:00", 100, AS_OF)["watermark"]


@query("rp_06_detailed_revenue", f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS txn_day, l_orderkey AS order_id, 'Part, ' || CAST(l_partkey AS STRING) AS product_name, p.barcode,
           l_quantity AS qty, l_extendedprice AS unit_price, l_extendedprice AS subtotal_excl_tax,
           'NATION_' || CAST(c_nationkey AS STRING) AS pos_name, CASE WHEN o_custkey % 5 <> 0 THEN c_name END AS agent
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN {{product}} p ON p.product_id = l_partkey
    WHERE l_linenumber <> 7 AND o_orderstatus <> 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '{WHOLE[0]}' AND DATE '{WHOLE[1]}'""")
def detailed_revenue(t):
    loaded = facts(t)
    return rp.detailed_revenue(loaded["lines"], loaded["orders"], *WHOLE)
