"""Joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_sources import NAMES, NAMES_SQL
from checks.registry import query
from checks.standins import PAYMENT_ID
from comptoir.functions.measures import age_days
from comptoir.functions.records import m2o_id, m2o_name
from comptoir.operators import aggregates as agg
from comptoir.operators import joins as jn
from comptoir.operators import sets as st
from comptoir.operators import windows as win
from comptoir.plans import reports as rp

METHODS = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "plain": "4-NOT SPECIFIED"}
# priority, code, pattern; the last rule is inactive and two share a priority
RULES = [
    ("RETURN", "R%", 1, True), ("FINAL_B", "%F/%", 2, True), ("FINAL_A", "%F/1%", 2, True),
    ("NINE", "%9", 5, True), ("ANY", "%/%", 9, True), ("NEVER", "%", 0, False),
]
RULES_SQL = "(VALUES " + ", ".join(f"('{c}', '{p}', {n}, {str(a).lower()})" for c, p, n, a in RULES) + ") AS rules(code, pattern, priority, is_active)"
RULE_SCHEMA = "code STRING, pattern STRING, priority INT, is_active BOOLEAN"
TEXT = "regexp_replace(CAST(CAST({c} AS DECIMAL(20,4)) AS STRING), '0{{{{1,3}}}}$', '')"


def rules(t):
    return t.spark.createDataFrame(RULES, RULE_SCHEMA)


@query("jn_01_star_join", """
    SELECT opening_date || '' AS opening_date, l.name_norm, p.category, CAST(sum(opening_qty) AS DOUBLE) AS qty
    FROM {opening} o JOIN {product} p ON p.product_id = o.product_id JOIN {location} l ON l.location_id = o.location_id
    GROUP BY ALL""")
def star_join(t):
    joined = jn.with_dims(
        t.opening, (t.product.select("product_id", "category"), "product_id"),
        (t.location.select("location_id", "name_norm"), "location_id"),
    )
    return joined.groupBy("opening_date", "name_norm", "category").agg(F.sum("opening_qty").alias("qty"))


@query("jn_02_cast_key_join", """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON CAST(o_custkey AS STRING) = CAST(c_custkey AS STRING)""")
def cast_key_join(t):
    orders = t.orders.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return jn.join_cast(orders, t.customer.select("c_custkey", "c_name"), "o_custkey", "c_custkey").select("o_orderkey", "c_name")


@query("jn_03_left_dimension", """
    SELECT payment_id, m.name FROM {pay} p LEFT JOIN {method} m ON m.method_id = p.method_id""")
def left_dimension(t):
    return jn.left_dim(t.pay, t.method, "method_id").select("payment_id", "name")


@query("jn_04_reconcile_sides", """
    SELECT l.location_id, a.lines, b.orders, c.stock FROM {location} l
    LEFT JOIN (SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY 1) a ON a.l_suppkey = l.location_id
    LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON b.l_suppkey = l.location_id
    LEFT JOIN (SELECT location_id, CAST(sum(opening_qty) AS DOUBLE) AS stock FROM {opening} GROUP BY 1) c ON c.location_id = l.location_id""")
def reconcile_sides(t):
    lines = t.lineitem.withColumnRenamed("l_suppkey", "location_id")
    a = lines.groupBy("location_id").agg(F.count(F.lit(1)).alias("lines"))
    b = lines.filter("l_returnflag = 'R'").groupBy("location_id").agg(F.count_distinct("l_orderkey").alias("orders"))
    c = agg.sum_by(t.opening, ["location_id"], "opening_qty", "stock")
    return jn.reconcile(t.location.select("location_id"), ["location_id"], a, b, c)


@query("jn_05_day_shop_join", """
    SELECT s.day || '' AS day, s.shop_key, s.sales, e.spent FROM
      (SELECT payment_day AS day, 'NATION' || CAST(config_id AS STRING) AS shop_key, CAST(sum(amount) AS DOUBLE) AS sales FROM {pay} GROUP BY 1, 2) s
      LEFT JOIN (SELECT expense_date AS day, replace(employee_name, 'EMP ', 'NATION') AS shop_key, CAST(sum(total_amount) AS DOUBLE) AS spent
                 FROM {expense} GROUP BY 1, 2) e ON e.day = s.day AND e.shop_key = s.shop_key""")
def day_shop_join(t):
    key = F.concat(F.lit("NATION"), F.col("config_id").cast("string"))
    sales = t.pay.groupBy(F.col("payment_day").alias("day"), key.alias("shop_key")).agg(F.sum("amount").alias("sales"))
    at = F.regexp_replace("employee_name", "EMP ", "NATION")
    spent = t.expense.groupBy(F.col("expense_date").alias("day"), at.alias("shop_key")).agg(F.sum("total_amount").alias("spent"))
    return jn.join_day_shop(sales, spent).select("day", "shop_key", "sales", "spent")


@query("jn_06_parameter_columns", """
    SELECT movement_day || '' AS movement_day, DATE '1998-01-01' - movement_day AS days_to, 'run' AS label FROM {movement}
    WHERE movement_day <= DATE '1998-01-01'""")
def parameter_columns(t):
    df = jn.with_params(t.movement.select("movement_day"), as_of=F.lit("1998-01-01").cast("date"), label="run")
    return df.filter(F.col("movement_day") <= F.col("as_of")).select(
        "movement_day", F.datediff("as_of", "movement_day").alias("days_to"), "label"
    )


@query("jn_07_validity_join", """
    SELECT expense_date || '' AS expense_date, m.shop_key, CAST(total_amount AS DOUBLE) AS total_amount
    FROM {expense} e JOIN {staff} m ON m.is_active AND m.employee_name = e.employee_name
         AND e.expense_date BETWEEN m.valid_from AND m.valid_to""")
def validity_join(t):
    return jn.join_valid(t.expense, t.staff, "employee_name", "expense_date").select("expense_date", "shop_key", "total_amount")


CLASSIFIED = f"""
    WITH best AS (SELECT r.ref, min_by(code, priority * 1000 + rank) AS code FROM
        (SELECT DISTINCT movement_ref AS ref FROM {{staged}} WHERE movement_ref IS NOT NULL) r
        JOIN (SELECT *, row_number() OVER (ORDER BY code) AS rank FROM {RULES_SQL} WHERE is_active) x ON r.ref LIKE x.pattern
        GROUP BY 1)
    SELECT move_line_id, product_id, movement_ref, code AS movement_type
    FROM {{staged}} LEFT JOIN best ON ref = movement_ref"""


@query("jn_08_rule_classification", CLASSIFIED)
def rule_classification(t):
    return jn.classify_by_rules(t.staged, rules(t)).select("move_line_id", "product_id", "movement_ref", "movement_type")


@query("jn_08_rule_table_classification", CLASSIFIED)
def rule_table_classification(t):
    """Several hundred rules, most of which match nothing, and some without a code or pattern."""
    idle = t.spark.range(600).selectExpr(
        "cast(id % 9 AS int) AS priority", "if(id % 50 = 0, NULL, concat('IDLE', id)) AS code",
        "if(id % 50 = 0, '%', if(id % 50 = 1, NULL, concat('no such document ', id, '%'))) AS pattern", "true AS is_active",
    )
    given = rules(t)
    more = idle.select(*[F.col(c).cast(given.schema[c].dataType) if c in idle.columns else F.lit(None).cast(given.schema[c].dataType).alias(c) for c in given.columns])
    typed = jn.classify_by_rules(t.staged, given.unionByName(more))
    return typed.select("move_line_id", "product_id", "movement_ref", "movement_type")


@query("jn_09_not_in_target", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'
    AND NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1998-01-01 00:00:00'
                    AND t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber)""")
def not_in_target(t):
    at = F.col("l_shipdate")
    source, target = t.lineitem.filter(at >= "1997-01-01"), t.lineitem.filter(at < "1998-01-01")
    return jn.not_in_target(source, target, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("jn_10_restrict_to_keys", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def restrict_to_keys(t):
    keys = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return jn.restrict_to(t.orders, keys, "o_orderkey").select("o_orderkey", "o_custkey")


@query("jn_11_location_usages", """
    SELECT move_line_id, product_id, a.usage AS source_usage, b.usage AS target_usage FROM {staged} s
    LEFT JOIN {location} a ON a.location_id = s.location_id LEFT JOIN {location} b ON b.location_id = s.location_dest_id""")
def location_usages(t):
    return jn.with_usages(t.staged, t.location).select("move_line_id", "product_id", "source_usage", "target_usage")


@query("jn_12_chained_lookup", """
    SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 3""")
def chained_lookup(t):
    # customer -> nation (as template) -> region (as category); the unit lookup finds nothing
    products = t.customer.select("c_custkey", F.col("c_nationkey").alias("template_id"))
    templates = t.nation.select(
        F.col("n_nationkey").alias("template_id"), F.col("n_regionkey").alias("category_id"), "n_name", F.lit(-1).alias("uom_id")
    )
    regions = t.region.filter("r_regionkey < 3").withColumnRenamed("r_regionkey", "category_id")
    units = t.region.select(F.col("r_regionkey").alias("uom_id"), F.lit("u").alias("uom_name"))
    return jn.enrich_product(products, templates, units, regions).select("c_custkey", "n_name", "r_name")


@query("jn_13_parent_order", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate || '' AS o_orderdate FROM lineitem JOIN
      (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o_orderkey = l_orderkey""")
def parent_order(t):
    heads = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return jn.attach_order(t.lineitem, heads, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate")


@query("jn_14_lines_with_orders", """
    SELECT o_orderpriority, l_returnflag, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(16,4))) AS DOUBLE) AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""")
def lines_with_orders(t):
    heads = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    amount = F.sum(F.col("l_extendedprice").cast("decimal(16,4)"))
    return jn.attach_order(t.lineitem, heads, "l_orderkey").groupBy("o_orderpriority", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), amount.alias("amount")
    )


@query("jn_15_fill_from_dimension", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_returnflag = 'A' THEN 'own' ELSE barcode END AS barcode
    FROM lineitem LEFT JOIN {product} ON product_id = l_partkey""")
def fill_from_dimension(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "A", "own").alias("barcode"),
    )
    return jn.fill_from(lines, t.product, "product_id", "barcode").drop("product_id")


@query("jn_16_hierarchy_paths", """
    WITH RECURSIVE node AS (
      SELECT 'r' || CAST(r_regionkey AS STRING) AS id, r_name AS name, CAST(NULL AS STRING) AS parent_id FROM region UNION ALL
      SELECT 'n' || CAST(n_nationkey AS STRING), CASE WHEN n_nationkey % 7 = 0 THEN ' ' ELSE n_name END,
             CASE WHEN n_nationkey % 6 = 0 THEN 'gone' ELSE 'r' || CAST(n_regionkey AS STRING) END FROM nation UNION ALL
      SELECT 's' || CAST(s_suppkey AS STRING), s_name, 'n' || CAST(s_nationkey AS STRING) FROM supplier UNION ALL
      SELECT 'c' || CAST(c_custkey AS STRING), c_name, CASE WHEN c_custkey < 3 THEN 'c' || CAST((c_custkey + 1) % 3 AS STRING)
             ELSE 's' || CAST(c_custkey % (SELECT count(*) FROM supplier) AS STRING) END FROM customer),
    walk AS (
      SELECT id, parent_id AS next, CASE WHEN trim(name) = '' THEN NULL ELSE trim(name) END AS path, [id] AS seen FROM node UNION ALL
      SELECT w.id, n.parent_id, CASE WHEN trim(n.name) = '' THEN w.path ELSE concat_ws(' / ', trim(n.name), w.path) END, list_append(w.seen, n.id)
      FROM walk w JOIN node n ON n.id = w.next WHERE NOT list_contains(w.seen, n.id))
    SELECT id, coalesce(max_by(path, len(seen)), '') AS path FROM walk GROUP BY id""")
def hierarchy_paths(t):
    def node(df, letter, key, name, parent):
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("id"), name.alias("name"), parent.cast("string").alias("parent_id"))

    suppliers = t.supplier.count()
    key = F.col("c_custkey")
    nodes = st.stack(
        node(t.region, "r", "r_regionkey", F.col("r_name"), F.lit(None)),
        node(t.nation, "n", "n_nationkey", F.when(F.col("n_nationkey") % 7 == 0, " ").otherwise(F.col("n_name")),
             F.when(F.col("n_nationkey") % 6 == 0, "gone").otherwise(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))),
        node(t.supplier, "s", "s_suppkey", F.col("s_name"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))),
        node(t.customer, "c", "c_custkey", F.col("c_name"),
             F.when(key < 3, F.concat(F.lit("c"), ((key + 1) % 3).cast("string")))
             .otherwise(F.concat(F.lit("s"), (key % suppliers).cast("string")))),
    )
    return jn.category_paths(nodes)


# ---- aggregations -------------------------------------------------------------


@query("ag_01_grouped_sum", "SELECT location_id, CAST(sum(opening_qty) AS DOUBLE) AS qty FROM {opening} GROUP BY 1")
def grouped_sum(t):
    return agg.sum_by(t.opening, ["location_id"], "opening_qty", "qty")


@query("ag_02_payment_pivot", """
    SELECT config_id, payment_day || '' AS payment_day, CAST(sum(amount) AS DOUBLE) AS total,
           CAST(sum(amount) FILTER (WHERE name = '1-URGENT') AS DOUBLE) AS urgent,
           CAST(sum(amount) FILTER (WHERE name = '2-HIGH') AS DOUBLE) AS high,
           CAST(sum(amount) FILTER (WHERE name = '3-MEDIUM') AS DOUBLE) AS medium,
           CAST(sum(amount) FILTER (WHERE name = '4-NOT SPECIFIED') AS DOUBLE) AS plain
    FROM {pay} p LEFT JOIN {method} m ON m.method_id = p.method_id GROUP BY 1, payment_day""")
def payment_pivot(t):
    named = jn.left_dim(t.pay, t.method.withColumnRenamed("name", "method_name"), "method_id")
    return agg.pay_by_method(named, ["config_id", "payment_day"], METHODS)


@query("ag_03_movement_in_out", """
    SELECT movement_day || '' AS movement_day, location_id,
           CAST(sum(CASE WHEN side = 'DST' THEN abs(qty) ELSE 0 END) AS DOUBLE) AS in_qty,
           CAST(sum(CASE WHEN side = 'SRC' THEN abs(qty) ELSE 0 END) AS DOUBLE) AS out_qty,
           CAST(sum(CASE WHEN side = 'SRC' THEN -abs(qty) ELSE abs(qty) END) AS DOUBLE) AS net_movement
    FROM {movement} WHERE regexp_matches(barcode, '^[A-Za-z]') AND barcode <> 'false' GROUP BY movement_day, location_id""")
def movement_in_out(t):
    return agg.movement_io(t.movement, ["movement_day", "location_id"])


@query("ag_04_movement_by_location", """
    SELECT movement_day || '' AS movement_day, m.location_id, name_norm, side, location_usage, is_internal, movement_type,
           CAST(sum(CASE WHEN side = 'SRC' THEN -abs(qty) ELSE abs(qty) END) AS DOUBLE) AS qty_final
    FROM {movement} m JOIN {location} l ON l.location_id = m.location_id
    GROUP BY movement_day, m.location_id, name_norm, side, location_usage, is_internal, movement_type""")
def movement_by_location(t):
    return agg.movement_by_location(t.movement.join(t.location.select("location_id", "name_norm"), "location_id"))


AGE_SUMS = """
           CAST(sum(CASE WHEN age < 30 THEN opening_qty ELSE 0 END) AS DOUBLE) AS stock_lt_30,
           CAST(sum(CASE WHEN age >= 30 AND age < 90 THEN opening_qty ELSE 0 END) AS DOUBLE) AS stock_30_90,
           CAST(sum(CASE WHEN age >= 90 AND age < 180 THEN opening_qty ELSE 0 END) AS DOUBLE) AS stock_90_180,
           CAST(sum(CASE WHEN age >= 180 AND age < 360 THEN opening_qty ELSE 0 END) AS DOUBLE) AS stock_180_360,
           CAST(sum(CASE WHEN age > 360 THEN opening_qty ELSE 0 END) AS DOUBLE) AS stock_gt_360"""


@query("ag_05_age_buckets", f"""
    SELECT location_id, {AGE_SUMS} FROM (SELECT *, opening_date - in_date AS age FROM {{opening}}) GROUP BY 1""")
def age_buckets(t):
    return agg.stock_age(t.opening, ["location_id"], age_days("in_date", F.col("opening_date")))


@query("ag_05_age_buckets_without_gap", f"""
    SELECT location_id, {AGE_SUMS.replace('> 360', '>= 360')} FROM (SELECT *, opening_date - in_date AS age FROM {{opening}}) GROUP BY 1""")
def age_buckets_without_gap(t):
    return agg.stock_age(t.opening, ["location_id"], age_days("in_date", F.col("opening_date")), close_gap=True)


def typed_payments(t):
    number = F.col("l_linenumber").cast("string")
    named = F.concat(F.lit("["), number, F.lit(',"Pay '), number, F.lit('"]'))
    method = F.when(F.col("l_linenumber") == 6, "[6]").otherwise(named)
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.expr(PAYMENT_ID).alias("payment_id"),
        m2o_id(method).alias("method_id"), m2o_name(method).alias("method_name"),
        F.col("l_extendedprice").cast("decimal(16,4)").alias("amount"),
    )


PAY_ROWS = f"""(SELECT l_orderkey AS order_id, {PAYMENT_ID} AS seq, CAST(l_linenumber AS BIGINT) AS method_id,
    CASE WHEN l_linenumber <> 6 THEN 'Pay ' || CAST(l_linenumber AS STRING) END AS method_name,
    CAST(l_extendedprice AS DECIMAL(16,4)) AS amount FROM lineitem)"""


PAY_PIECE = f"""coalesce(method_name, 'PM_' || CAST(method_id AS STRING)) || ': ' || {TEXT.format(c='coalesce(amount, 0)')}"""


@query("ag_06_payment_text", f"""
    SELECT order_id, 0 AS part, string_agg(part, ' | ' ORDER BY seq, part) AS payment_text FROM (
      SELECT order_id, seq, {PAY_PIECE} AS part FROM {PAY_ROWS}) GROUP BY 1""")
def payment_text(t):
    """Nameless payments stand under their method's id."""
    return agg.payment_text(typed_payments(t))


@query("ag_06_payment_text_parts", f"""
    SELECT order_id, CAST(floor((pos - 1) / 3) AS INTEGER) AS part, string_agg(part, ' | ' ORDER BY pos) AS payment_text FROM (
      SELECT order_id, row_number() OVER (PARTITION BY order_id ORDER BY seq, part) AS pos, part FROM (
        SELECT order_id, seq, {PAY_PIECE} AS part FROM {PAY_ROWS})) GROUP BY 1, 2""")
def payment_text_parts(t):
    """Parts of three payments by position."""
    return agg.payment_text(typed_payments(t), part_size=3)


@query("ag_07_payment_summary", f"""
    SELECT order_id, CASE WHEN count(*) = 1 THEN min(method_id) END AS method_id,
           string_agg(label || ': ' || {TEXT.format(c='amount')}, ' | ' ORDER BY method_id) AS payment_text FROM (
      SELECT order_id, method_id, coalesce(max(method_name), 'PM_' || CAST(method_id AS STRING)) AS label, sum(amount) AS amount
      FROM {PAY_ROWS} GROUP BY order_id, method_id) GROUP BY order_id""")
def payment_summary(t):
    return agg.payment_summary(typed_payments(t))


@query("ag_08_max_timestamp", """
    SELECT CAST(max(ts) AS STRING) AS max_ts FROM events""")
def max_timestamp(t):
    return agg.max_ts(t.events, "ts")


@query("ag_09_max_pair", """
    SELECT CAST(l_shipdate AS STRING) AS watermark_ts, l_orderkey AS watermark_id FROM lineitem WHERE l_returnflag <> 'N'
    ORDER BY l_shipdate DESC, l_orderkey DESC LIMIT 1""")
def max_pair(t):
    usable = t.lineitem.withColumn("l_shipdate", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")))
    return agg.max_ts_id(usable, "l_shipdate", "l_orderkey")


@query("ag_10_distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(t):
    return agg.distinct_keys(t.lineitem, "l_partkey", "l_suppkey")


@query("ag_11_duplicate_audit", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, occurrences FROM (
      SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS occurrences FROM lineitem) WHERE occurrences > 1""")
def duplicate_audit(t):
    return agg.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "occurrences"
    )


@query("ag_12_load_statistics", """
    SELECT count(*) AS total_rows, sum(CASE WHEN ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 5 MINUTES THEN 1 ELSE 0 END) AS recent_rows
    FROM events""")
def load_statistics(t):
    return agg.load_stats(t.events, "ts", "2024-01-30 00:00:00")


@query("ag_13_opening_summary", """
    SELECT opening_date || '' AS opening_date, name_norm, CAST(sum(opening_qty) AS DOUBLE) AS qty,
           CAST(sum(value_cost) AS DOUBLE) AS cost, CAST(sum(value_sale) AS DOUBLE) AS price
    FROM {opening} o JOIN {location} l ON l.location_id = o.location_id GROUP BY opening_date, name_norm""")
def opening_summary(t):
    named = t.opening.join(t.location.select("location_id", "name_norm"), "location_id")
    return agg.opening_summary(named, ["opening_date", "name_norm"])


# ---- windows -------------------------------------------------------------------


def shop_days(t):
    return t.pay.groupBy("config_id", F.col("payment_day").alias("day")).agg(F.sum("amount").alias("total"))


@query("wn_01_number_rows", """
    SELECT config_id, payment_day || '' AS day, CAST(sum(amount) AS DOUBLE) AS total,
           row_number() OVER (PARTITION BY payment_day ORDER BY config_id) AS numero FROM {pay} GROUP BY config_id, payment_day""")
def number_rows(t):
    return win.numbered(shop_days(t), ["config_id"])


@query("wn_02_number_period", """
    SELECT config_id, payment_day || '' AS day, CAST(sum(amount) AS DOUBLE) AS total,
           row_number() OVER (ORDER BY payment_day, config_id) AS numero FROM {pay} GROUP BY config_id, payment_day""")
def number_period(t):
    return win.numbered(shop_days(t), ["config_id"], period=True)


@query("wn_03_keep_latest", """
    SELECT l_orderkey, l_linenumber, l_shipdate || '' AS l_shipdate, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def keep_latest(t):
    latest = win.dedup_latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_quantity"])
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


@query("wn_04_duplicate_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey) > 1 THEN 1 ELSE 0 END AS dup_flag FROM lineitem""")
def duplicate_flag(t):
    flagged = win.flag_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "dup_flag")


# ---- set operations --------------------------------------------------------------


@query("st_01_union_with_labels", """
    SELECT 'OPENING' AS kind, location_id, CAST(opening_qty AS DOUBLE) AS qty, CAST(NULL AS BIGINT) AS move_line_id FROM {opening}
    UNION ALL SELECT 'MOVE', location_id, CAST(signed_qty AS DOUBLE), move_line_id FROM {movement}""")
def union_with_labels(t):
    opening = t.opening.select(F.lit("OPENING").alias("kind"), "location_id", F.col("opening_qty").alias("qty"))
    moves = t.movement.select(F.lit("MOVE").alias("kind"), "location_id", F.col("signed_qty").alias("qty"), "move_line_id")
    return st.stack(opening, moves)


@query("st_02_all_days_at_once", """
    SELECT day || '' AS day, count(l_orderkey) AS lines, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(16,4))), 0) AS DOUBLE) AS qty
    FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
    LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = day GROUP BY day""")
def all_days_at_once(t):
    by_day = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("decimal(16,4)")).alias("qty")
    )
    spine = st.day_spine(t.spark, "1995-01-01", "2001-12-31")
    return spine.join(by_day, "day", "left").select("day", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("qty", F.lit(0)).alias("qty"))


@query("st_03_double_entry", """
    SELECT move_line_id, product_id, 'SRC' AS side, location_id FROM {staged} UNION ALL
    SELECT move_line_id, product_id, 'DST', location_dest_id FROM {staged}""")
def double_entry(t):
    moves = t.staged.select("move_line_id", "product_id", "location_id", "location_dest_id")
    both = st.to_double_entry(moves, {"location_id": F.col("location_id")}, {"location_id": F.col("location_dest_id")})
    return both.select("move_line_id", "product_id", "side", "location_id")


# ---- reports -------------------------------------------------------------------------

WHOLE = ("1995-01-01", "2001-12-31")


def revenue_sql(first: str, last: str, renumber: bool) -> str:
    number = "ORDER BY s.day, s.shop" if renumber else "PARTITION BY s.day ORDER BY s.shop"
    return f"""
    WITH sales AS (
      SELECT c.name AS shop, payment_day AS day, sum(amount) AS total,
             sum(amount) FILTER (WHERE m.name = '1-URGENT') AS urgent, sum(amount) FILTER (WHERE m.name = '2-HIGH') AS high,
             sum(amount) FILTER (WHERE m.name = '3-MEDIUM') AS medium, sum(amount) FILTER (WHERE m.name = '4-NOT SPECIFIED') AS plain
      FROM {{pay}} p JOIN {{shop}} c ON c.shop_id = p.config_id LEFT JOIN {{method}} m ON m.method_id = p.method_id
      WHERE payment_day BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY 1, 2),
    spent AS (
      SELECT expense_date AS day, shop_key, sum(total_amount) AS expenses FROM {{expense}} e JOIN {{staff}} m
        ON m.is_active AND m.employee_name = e.employee_name AND expense_date BETWEEN valid_from AND valid_to
      WHERE coalesce(total_amount, 0) <> 0 AND expense_date BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY 1, 2)
    SELECT row_number() OVER ({number}) AS numero, s.shop, s.day || '' AS day, CAST(total AS DOUBLE) AS total_sales,
           CAST(coalesce(urgent, 0) AS DOUBLE) AS urgent, CAST(coalesce(high, 0) AS DOUBLE) AS high,
           CAST(coalesce(medium, 0) AS DOUBLE) AS medium, CAST(coalesce(plain, 0) AS DOUBLE) AS plain,
           CAST(coalesce(expenses, 0) AS DOUBLE) AS expenses, CAST(urgent - coalesce(expenses, 0) AS DOUBLE) AS to_deposit
    FROM sales s LEFT JOIN spent e ON e.day = s.day
         AND e.shop_key = regexp_replace(upper(trim(s.shop)), '[\\s\\-_]+', '', 'g')"""


def revenue_frames(t):
    return t.pay, t.shop, t.method, t.expense, t.staff


REVENUE = dict(pay_methods=METHODS, cash="urgent")


@query("rp_01_daily_revenue", revenue_sql(*WHOLE, False))
def daily_revenue(t):
    return rp.daily_revenue(*revenue_frames(t), *WHOLE, **REVENUE)


@query("rp_02_revenue_of_period", revenue_sql(*WHOLE, True))
def revenue_of_period(t):
    return rp.daily_revenue_period(*revenue_frames(t), from_day=WHOLE[0], to_day=WHOLE[1], **REVENUE)


@query("rp_02_month_to_date", revenue_sql("1998-03-01", "1998-03-19", True))
def month_to_date(t):
    return rp.daily_revenue_period(*revenue_frames(t), from_day="1998-03-19", **REVENUE)


SITUATION = f"""
    WITH days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{WHOLE[0]}', TIMESTAMP '{WHOLE[1]}', INTERVAL 1 DAY)) AS DATE) AS day),
    held AS (SELECT opening_date, location_id, sum(opening_qty) AS qty FROM {{opening}} GROUP BY 1, 2),
    moved AS (SELECT movement_day, location_id, sum(CASE WHEN side = 'DST' THEN abs(qty) ELSE 0 END) AS in_qty,
              sum(CASE WHEN side = 'SRC' THEN abs(qty) ELSE 0 END) AS out_qty FROM {{movement}}
              WHERE regexp_matches(barcode, '^[A-Za-z]') AND barcode <> 'false' GROUP BY 1, 2)
    SELECT d.day || '' AS day, l.location_id, l.name_norm, CAST(coalesce(p.qty, 0) AS DOUBLE) AS open_qty_prev,
           CAST(coalesce(in_qty, 0) AS DOUBLE) AS in_qty, CAST(coalesce(-out_qty, 0) AS DOUBLE) AS out_qty,
           CAST(coalesce(in_qty - out_qty, 0) AS DOUBLE) AS net_movement,
           CAST(coalesce(p.qty, 0) + coalesce(in_qty - out_qty, 0) AS DOUBLE) AS closing_qty,
           CAST(coalesce(c.qty, 0) AS DOUBLE) AS open_qty_curr,
           CAST(coalesce(c.qty, 0) - (coalesce(p.qty, 0) + coalesce(in_qty - out_qty, 0)) AS DOUBLE) AS variance
    FROM {{location}} l CROSS JOIN days d
    LEFT JOIN held p ON p.opening_date = d.day - 1 AND p.location_id = l.location_id
    LEFT JOIN held c ON c.opening_date = d.day AND c.location_id = l.location_id
    LEFT JOIN moved m ON m.movement_day = d.day - 1 AND m.location_id = l.location_id
    WHERE l.name_norm IN ({NAMES_SQL})"""


@query("rp_03_stock_situation", SITUATION)
def stock_situation(t):
    return rp.stock_situation(t.opening, t.movement, t.location, *WHOLE, names=NAMES)


@query("rp_04_stock_movement", f"""
    SELECT movement_day || '' AS movement_day, m.location_id, l.name_norm, side, location_usage, is_internal, movement_type,
           CAST(sum(CASE WHEN side = 'SRC' THEN -abs(qty) ELSE abs(qty) END) AS DOUBLE) AS qty_final
    FROM {{movement}} m JOIN {{location}} l ON l.location_id = m.location_id JOIN {{product}} p ON p.product_id = m.product_id
    WHERE m.barcode IS NOT NULL AND regexp_matches(m.barcode, '^[A-Za-z]') AND m.barcode <> 'false'
          AND movement_day BETWEEN DATE '{WHOLE[0]}' AND DATE '{WHOLE[1]}'
    GROUP BY movement_day, m.location_id, l.name_norm, side, location_usage, is_internal, movement_type""")
def stock_movement(t):
    return rp.stock_movement(t.movement, t.location, t.product, *WHOLE)


@query("rp_05_stock_age", f"""
    SELECT opening_date || '' AS opening_date, l.complete_name AS location, {AGE_SUMS}
    FROM (SELECT *, DATE '2001-06-30' - in_date AS age FROM {{opening}}) o
    JOIN {{product}} p ON p.product_id = o.product_id JOIN {{location}} l ON l.location_id = o.location_id
    WHERE opening_date BETWEEN DATE '{WHOLE[0]}' AND DATE '{WHOLE[1]}' GROUP BY o.opening_date, l.complete_name""")
def stock_age(t):
    return rp.stock_age_report(t.opening, t.product, t.location, WHOLE[0], "2001-06-30", WHOLE[1])


@query("rp_07_stock_opening", f"""
    SELECT opening_date || '' AS opening_date, o.product_id, p.barcode, p.name_norm AS product_name, l.name_norm,
           CAST(opening_qty AS DOUBLE) AS opening_qty, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(unit_sale_price AS DOUBLE) AS unit_sale_price
    FROM {{opening}} o JOIN {{location}} l ON l.location_id = o.location_id JOIN {{product}} p ON p.product_id = o.product_id
    WHERE p.barcode IS NOT NULL AND regexp_matches(p.barcode, '^[A-Za-z]') AND p.barcode <> 'false'
          AND opening_date BETWEEN DATE '{WHOLE[0]}' AND DATE '{WHOLE[1]}'""")
def stock_opening(t):
    return rp.stock_opening_listing(t.opening, t.location, t.product, *WHOLE)


@query("rp_08_stock_exceptions", f"""
    SELECT * FROM (
      SELECT opening_date || '' AS opening_date, p.barcode, l.complete_name AS location, p.name_norm AS product_name, category_norm AS category,
             CAST(opening_qty AS DOUBLE) AS opening_qty, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(unit_sale_price AS DOUBLE) AS unit_sale_price,
             CASE WHEN opening_qty < 0 THEN 'STOCK NEGATIF' WHEN opening_qty > 1 THEN 'STOCK > 1' ELSE 'OK' END AS status_qty,
             CASE WHEN unit_sale_price = 0 AND unit_cost = 0 THEN 'PRIX & COUT NULS' WHEN unit_sale_price > 0 AND unit_cost = 0 THEN 'COUT MANQUANT'
                  WHEN unit_sale_price = 0 AND unit_cost > 0 THEN 'PRIX DE VENTE MANQUANT' ELSE 'OK' END AS status_financial
      FROM {{opening}} o JOIN {{product}} p ON p.product_id = o.product_id JOIN {{location}} l ON l.location_id = o.location_id
      WHERE p.is_current AND o.opening_date BETWEEN DATE '{WHOLE[0]}' AND DATE '{WHOLE[1]}')
    WHERE status_qty <> 'OK' OR status_financial <> 'OK'""")
def stock_exceptions(t):
    return rp.stock_exceptions(t.opening, t.product, t.location, *WHOLE)


@query("rp_09_last_days", revenue_sql("2001-07-29", "2001-07-31", False))
def last_days(t):
    return rp.daily_revenue_last(*revenue_frames(t), as_of="2001-08-01", **REVENUE)


@query("rp_10_sections_by_day", f"""
    SELECT d.day || '' AS day, day(d.day) AS section, r.* EXCLUDE (day) FROM
      (SELECT CAST(unnest(generate_series(TIMESTAMP '1998-03-01', TIMESTAMP '1998-03-19', INTERVAL 1 DAY)) AS DATE) AS day) d
      LEFT JOIN ({revenue_sql('1998-03-01', '1998-03-19', False)}) r ON r.day = d.day || ''""")
def sections_by_day(t):
    return rp.daily_revenue_by_day(t.spark, *revenue_frames(t), day="1998-03-19", **REVENUE)
