"""Scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from comptoir.functions import measures as m
from comptoir.functions import names as n
from comptoir.functions import records as r

# category words of the generated parts, in the order the classifier tries them
PART_KEYWORDS = ("SMALL", "PROMO", "LARGE", "ECONOMY")
PLAIN_QTY = "regexp_replace(CAST(CAST({c} AS DECIMAL(20,4)) AS STRING), '0{{{{1,3}}}}$', '')"


@query("fn_01_many2one", """
    SELECT event_id, CASE WHEN value > 250 THEN NULL ELSE user_id END AS rel_id,
           CASE WHEN value > 250 OR value < 100 THEN NULL ELSE event_type || ', x' END AS rel_name
    FROM events""")
def many2one(t):
    pair = F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(',"'), "event_type", F.lit(', x"]'))
    rel = F.when(F.col("value") > 250, "false").when(F.col("value") < 100, F.col("user_id").cast("string")).otherwise(pair)
    return t.events.select("event_id", r.m2o_id(rel).alias("rel_id"), r.m2o_name(rel).alias("rel_name"))


@query("fn_02_clean_false", """
    SELECT p_partkey, CASE WHEN barcode <> 'false' THEN barcode END AS barcode
    FROM part JOIN {product} ON product_id = p_partkey""")
def clean_false(t):
    return t.product.select(F.col("product_id").alias("p_partkey"), r.clean_false("barcode").alias("barcode"))


@query("fn_03_parse_timestamp", """
    SELECT id, CASE WHEN date_order <> 'bad' THEN date_order END AS placed FROM {order_raw}""")
def parse_timestamp(t):
    return t.order_raw.select("id", r.parse_dt("date_order").alias("placed"))


@query("fn_04_safe_number", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'error' THEN NULL ELSE value END AS number
    FROM events""")
def safe_number(t):
    text = F.when(F.col("event_type") == "view", "false").when(F.col("event_type") == "error", "1.5d")
    text = text.otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", r.safe_double(text).alias("number"))


@query("fn_05_date_key", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key FROM orders""")
def date_key(t):
    return t.orders.select("o_orderkey", m.date_key("o_orderdate").alias("date_key"))


@query("fn_06_code_prefix", """
    SELECT p_partkey, position('-' IN name) > 0 AND trim(split_part(name, '-', 1)) <> '' AS coded
    FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN p_name WHEN p_size < 20 THEN '  - ' || p_name
                 ELSE p_brand || '-' || p_name END AS name FROM part)""")
def code_prefix(t):
    name = F.when(F.col("p_size") < 10, F.col("p_name")).when(F.col("p_size") < 20, F.concat(F.lit("  - "), "p_name"))
    name = name.otherwise(F.concat("p_brand", F.lit("-"), "p_name"))
    return t.part.select("p_partkey", n.has_code_prefix(name).alias("coded"))


@query("fn_07_product_name", """
    SELECT product_id, upper(regexp_replace(trim(CASE WHEN product_id % 2 = 0 THEN p_name
             WHEN product_id % 3 = 0 THEN p_name || ' - Extra' ELSE p_name END), '\\s+', ' ', 'g')) AS name_norm
    FROM {product} JOIN part ON p_partkey = product_id""")
def product_name(t):
    raw = (
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" [tag 1]  "), "p_brand", F.lit(" -  "), "p_name"))
        .when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit("-[y] "), "p_name", F.lit("  -   Extra ")))
        .otherwise(F.concat(F.lit("[z]"), "p_name"))
    )
    return t.part.select(F.col("p_partkey").alias("product_id"), n.norm_product(raw).alias("name_norm"))


@query("fn_08_unit_name", """
    SELECT p_partkey, CASE WHEN p_size % 6 IN (0, 1, 3, 4, 5) THEN 'Units' ELSE 'Box' END AS uom FROM part""")
def unit_name(t):
    units = t.unit_raw.withColumnRenamed("name", "uom_name")
    part = t.part.withColumn("id", (F.col("p_size") % 6).cast("bigint"))
    return part.join(units, "id").select("p_partkey", n.canon_uom("uom_name").alias("uom"))


@query("fn_09_category", """
    SELECT p_partkey, category FROM (
      SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'PROMO', 'LARGE', 'ECONOMY') THEN 'VENTE / ' || p_type END AS category
      FROM part) WHERE category IS NOT NULL""")
def category(t):
    path = F.concat(F.lit("All / "), F.lower("p_type"))
    out = t.part.select("p_partkey", n.pos_category(path, PART_KEYWORDS).alias("category"))
    return out.filter(F.col("category").isNotNull())


@query("fn_10_site", """
    SELECT location_id, CASE WHEN complete_name LIKE 'DEPOT/CENTRAL%' THEN 'DEPOT_CENTRAL'
           WHEN complete_name LIKE 'BOUTIQUE%' THEN 'BOUTIQUE' ELSE 'OTHER' END AS site FROM {location}""")
def site(t):
    return t.location.select("location_id", n.norm_site(F.lower("complete_name")).alias("site"))


@query("fn_11_tracked_product", """
    SELECT product_id, sale_ok AND NOT starts_with(lower(name), 'brand#2') AND NOT starts_with(lower(name), '[vieux')
           AND (lower(name) LIKE '%small%' OR lower(name) LIKE '%ring%' OR lower(name) LIKE '%bolt%') AS tracked,
           sale_ok AND (lower(name) LIKE '%small%' OR lower(name) LIKE '%ring%' OR lower(name) LIKE '%bolt%') AS tracked_untrimmed
    FROM (SELECT product_id, sale_ok, name_raw AS name FROM {product})""")
def tracked_product(t):
    rule = dict(keywords=("small", "ring", "bolt"), excluded=("brand#2", "[vieux"))
    name = F.concat(F.lit("  "), "name_raw")
    return t.product.select(
        "product_id",
        n.is_tracked_product(name, "sale_ok", **rule).alias("tracked"),
        n.is_tracked_product(name, "sale_ok", strip=False, **rule).alias("tracked_untrimmed"),
    )


@query("fn_12_shop_key", """
    SELECT c_custkey, upper(replace(c_name, ' ', '')) || upper(c_mktsegment) AS shop_key FROM customer""")
def shop_key(t):
    name = F.concat(F.lit(" "), "c_name", F.lit(" - _"), "c_mktsegment", F.lit("  "))
    return t.customer.select("c_custkey", n.shop_key(name).alias("shop_key"))


@query("fn_13_valid_barcode", """
    SELECT product_id, barcode FROM {product}
    WHERE barcode IS NOT NULL AND regexp_matches(barcode, '^[A-Za-z]') AND barcode <> 'false'""")
def valid_barcode(t):
    return t.product.filter(n.valid_barcode("barcode")).select("product_id", "barcode")


@query("fn_14_movement_reference", """
    SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey, l_partkey,
           CASE WHEN l_linestatus <> 'O' THEN l_returnflag || l_linestatus || '/' || CAST(l_orderkey AS STRING)
                WHEN l_returnflag <> 'N' THEN 'REF/' || CAST(l_orderkey AS STRING) ELSE 'Shown' END AS ref
    FROM lineitem""")
def movement_reference(t):
    return t.line_raw.select(
        "id", r.m2o_id("move_id").alias("l_orderkey"), r.m2o_id("product_id").alias("l_partkey"),
        r.movement_ref("picking_id", "reference", F.lit("Shown")).alias("ref"),
    )


@query("fn_14_movement_reference_payload", """
    SELECT move_line_id, product_id, coalesce(movement_ref,
             CASE WHEN move_line_id % 8 <> 1 THEN 'PICK/' || CAST(move_id AS STRING) END) AS ref FROM {staged}""")
def movement_reference_payload(t):
    return t.staged.select(
        "move_line_id", "product_id", r.movement_ref_or_payload("movement_ref", "payload").alias("ref")
    )


@query("fn_15_movement_day", """
    SELECT move_line_id, product_id, CAST(CAST(coalesce(write_ts, business_ts + INTERVAL 1 DAY) AS DATE) AS STRING) AS by_write,
           CAST(CAST(business_ts + INTERVAL 1 DAY AS DATE) AS STRING) AS by_business FROM {staged}""")
def movement_day(t):
    later = F.col("business_ts") + F.expr("INTERVAL 1 DAY")
    return t.staged.select(
        "move_line_id", "product_id",
        m.movement_day("write_ts", later).alias("by_write"),
        m.movement_day("write_ts", later, "date").alias("by_business"),
    ).filter(F.col("by_write").isNotNull())


@query("fn_16_payment_time", """
    SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey,
           CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN date_trunc('day', l_shipdate)
                ELSE l_shipdate END AS STRING) AS paid_at
    FROM lineitem""")
def payment_time(t):
    rows = t.lineitem.withColumns({
        "p": F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")),
        "c": F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")),
    })
    at = m.payment_dt(F.col("p"), F.col("c"), None, F.col("l_shipdate").cast("date"))
    return rows.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_partkey", at.alias("paid_at"))


@query("fn_17_duplicate_key", f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           md5(CAST(l_orderkey AS STRING) || '|' || CASE WHEN l_linestatus = 'O' THEN 'None' ELSE CAST(l_shipdate AS STRING) END
               || '|' || CASE WHEN l_returnflag = 'N' THEN 'None' ELSE {PLAIN_QTY.format(c='l_quantity * 1000000')} END) AS dup_key
    FROM lineitem""")
def duplicate_key(t):
    ts = F.when(F.col("l_linestatus") != "O", F.col("l_shipdate"))
    qty = F.when(F.col("l_returnflag") != "N", F.col("l_quantity") * 1000000)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", m.dup_key("l_orderkey", ts, qty).alias("dup_key"))


@query("fn_18_signed_quantity", """
    SELECT move_line_id, product_id, side,
           CASE WHEN NOT is_internal THEN 0.0 WHEN side = 'SRC' THEN -CAST(qty AS DOUBLE) ELSE CAST(qty AS DOUBLE) END AS own_qty,
           CASE WHEN side = 'SRC' THEN -CAST(qty AS DOUBLE) ELSE CAST(qty AS DOUBLE) END AS any_qty
    FROM {movement}""")
def signed_quantity(t):
    qty = -F.col("qty")
    return t.movement.select(
        "move_line_id", "product_id", "side",
        m.signed_qty("side", qty, "is_internal").alias("own_qty"),
        m.movement_qty("side", qty).alias("any_qty"),
    )


@query("fn_19_value", """
    SELECT move_line_id, product_id,
           CAST(CAST(abs(qty_done) * unit_sale_price AS DECIMAL(18,4)) AS DOUBLE) AS value_sale,
           CAST(CAST(abs(qty_done) * coalesce(unit_cost, 0) AS DECIMAL(18,4)) AS DOUBLE) AS value_cost
    FROM {staged}""")
def value(t):
    return t.staged.select(
        "move_line_id", "product_id",
        m.value("qty_done", "unit_sale_price").alias("value_sale"), m.value("qty_done", "unit_cost").alias("value_cost"),
    )


@query("fn_20_status", """
    SELECT product_id, location_id, opening_date || '' AS opening_date,
           CASE WHEN opening_qty < 0 THEN 'STOCK NEGATIF' WHEN opening_qty > 1 THEN 'STOCK > 1' ELSE 'OK' END AS status_qty,
           CASE WHEN unit_sale_price = 0 AND unit_cost = 0 THEN 'PRIX & COUT NULS'
                WHEN unit_sale_price > 0 AND unit_cost = 0 THEN 'COUT MANQUANT'
                WHEN unit_sale_price = 0 AND unit_cost > 0 THEN 'PRIX DE VENTE MANQUANT' ELSE 'OK' END AS status_financial
    FROM {opening}""")
def status(t):
    return t.opening.select(
        "product_id", "location_id", "opening_date", m.qty_status("opening_qty").alias("status_qty"),
        m.fin_status("unit_sale_price", "unit_cost").alias("status_financial"),
    )


@query("fn_21_age_days", """
    SELECT product_id, location_id, DATE '1998-01-01' - in_date AS age FROM {opening}""")
def age(t):
    return t.opening.select("product_id", "location_id", m.age_days("in_date", "1998-01-01").alias("age"))


@query("fn_22_defaults", """
    SELECT move_line_id, product_id, coalesce(movement_ref, 'INCONNU') AS movement_ref,
           coalesce(CAST(unit_cost AS DOUBLE), 0) AS unit_cost,
           CAST(CAST(coalesce(write_ts, business_ts) AS TIMESTAMP) AS STRING) AS write_ts
    FROM {staged}""")
def defaults(t):
    filled = m.with_defaults(t.staged, {"movement_ref": "INCONNU", "unit_cost": 0, "write_ts": F.col("business_ts")})
    return filled.select("move_line_id", "product_id", "movement_ref", "unit_cost", "write_ts")


@query("fn_23_overflow_guard", """
    SELECT id, amount, abs(amount) < 1e12 AS kept FROM {payment_raw}""")
def overflow_guard(t):
    fits, over = m.split_overflow(t.payment_raw.select("id", "amount"), "amount")
    return fits.withColumn("kept", F.lit(True)).unionByName(over.withColumn("kept", F.lit(False)))


@query("fn_24_surrogate_key", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           md5(CAST(l_orderkey AS STRING) || '|' || CAST(l_linenumber AS STRING) || '|'
                  || CASE WHEN l_returnflag = 'N' THEN '\\N' ELSE l_returnflag END) AS row_key
    FROM lineitem""")
def surrogate(t):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", m.surrogate_key("l_orderkey", "l_linenumber", flag).alias("row_key")
    )


@query("fn_25_json_path", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_path(t):
    return t.events.select("event_id", r.json_path("props", "$.k").cast("bigint").alias("k"))
