"""Loads as they run one after the other: capped slices, stored tables, run logs, state kept between loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.q_changes import ALL, KEY, merged_sql, old_and_new
from checks.q_datasets import (
    AS_OF, ENTRIES_SQL, ENTRY_COLUMNS, EXPENSE_COLUMNS, EXPENSE_LATEST, HIST, PAID, PLAIN, exact_payments, latest_expenses, old_expenses, staged_lines,
)
from checks.q_relational import PAY_PIECE, PAY_ROWS, rules, typed_payments
from checks.q_sources import EXTRACT_SQL, extract_columns
from checks.registry import QUERIES, query
from comptoir.functions.records import m2o_id, parse_dt
from comptoir.operators import aggregates as agg
from comptoir.operators import incremental as inc
from comptoir.operators import joins as jn
from comptoir.operators import merge as mg
from comptoir.operators.windows import dedup_latest
from comptoir.plans import expenses as ex
from comptoir.plans import movements as mv
from comptoir.plans import pos, stock
from comptoir.schemas import RUN_LOG
from comptoir.session import cut_lineage, scratch_path
from comptoir.sources import slices
from comptoir.streaming import inbox as stream


@query("jn_08_rules_of_every_customer", """
    WITH refs AS (SELECT DISTINCT movement_ref AS ref FROM {staged} WHERE movement_ref IS NOT NULL),
    best AS (SELECT ref, min_by(code, (priority, code)) AS code FROM refs JOIN (
        SELECT 'C' || CAST(c_custkey AS STRING) AS code, substr('RFNOAF', CAST(c_custkey % 5 AS INTEGER) + 1, 2) || '/' || CAST(c_custkey AS STRING) || '%' AS pattern,
               c_nationkey AS priority FROM customer UNION ALL SELECT 'LAST', '%7', 99) x ON ref LIKE pattern GROUP BY 1)
    SELECT move_line_id, product_id, movement_ref, code AS movement_type FROM {staged} LEFT JOIN best ON ref = movement_ref""")
def rules_of_every_customer(t):
    """A rule for each customer, looked up by its literal beginning."""
    kind = F.substring(F.lit("RFNOAF"), (F.col("c_custkey") % 5 + 1).cast("int"), F.lit(2))
    own = t.customer.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"), F.concat(kind, F.lit("/"), F.col("c_custkey").cast("string"), F.lit("%")).alias("pattern"),
        F.col("c_nationkey").alias("priority"), F.lit(True).alias("is_active"),
    )
    last = t.spark.createDataFrame([("LAST", "%7", 99, True)], own.schema)
    return jn.classify_by_rules(t.staged, own.unionByName(last)).select("move_line_id", "product_id", "movement_ref", "movement_type")


@query("src_04_slices_in_turn", """
    SELECT event_id, CAST(ts AS STRING) AS ts, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // (SELECT CAST(ceil(count(*) / 4) AS BIGINT) FROM events) AS INTEGER) AS turn FROM events""")
def slices_in_turn(t):
    """Four capped slices, each from the watermark of the one before."""
    size = -(-t.events.count() // 4)
    since, out = ("2000-01-01 00:00:00", 0), None
    for turn in range(4):
        part = slices.slice_since(t.events, "ts", "event_id", *since, max_rows=size)
        top = agg.max_ts_id(part, "ts", "event_id").first()
        since = (top["watermark_ts"], top["watermark_id"])
        part = part.select("event_id", "ts", F.lit(turn).alias("turn"))
        out = part if out is None else out.unionByName(part)
    return out


@query("mrg_01_upsert_missing_keys", merged_sql(ALL) + """
    UNION ALL SELECT NULL, l_linenumber, l_partkey, l_quantity, l_returnflag, CAST(CAST(l_shipdate AS DATE) AS STRING) FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' AND l_orderkey % 3 = 0
    UNION ALL SELECT NULL, l_linenumber, l_partkey, l_quantity, l_returnflag, CAST(CAST(l_shipdate AS DATE) AS STRING) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_orderkey % 3 = 0""")
def upsert_missing_keys(t):
    """Rows without an order on both sides, a third of all: they match nothing and stay."""
    old, new = old_and_new(t)
    lines = t.lineitem.filter("l_orderkey % 3 = 0").withColumns({"l_orderkey": F.lit(None).cast("bigint"), "made": F.col("l_shipdate").cast("date")})
    before, after = lines.filter("made < '2000-01-01'").select(old.columns), lines.filter("made >= '1997-01-01'").select(new.columns)
    return mg.upsert(old.unionByName(before), new.unionByName(after), KEY, insert_only=["made"])


@query("mrg_04_rewrite_touched_files", merged_sql({**ALL, "made": "n.made"}, part=True))
def rewrite_touched_files(t):
    """The stored form by file: of the years that the batch brings, only files that hold one of its keys are rewritten."""
    path = scratch_path(t.spark, "table")
    old, new = old_and_new(t, part=True)
    old.repartitionByRange(4, "l_orderkey").write.partitionBy("part").parquet(path)
    keys = KEY + ["part"]
    for batch in (new.filter("l_orderkey < 100"), new):
        mg.store_by_file(t.spark, path, batch, "part", keys, lambda target, b: mg.upsert(target, b, keys))
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query("ag_06_payment_text_of_one_order", f"""
    SELECT 1 AS order_id, CAST(floor((pos - 1) / 1000) AS INTEGER) AS part, string_agg(part, ' | ' ORDER BY pos) AS payment_text FROM (
      SELECT row_number() OVER (ORDER BY seq NULLS LAST, part) AS pos, part FROM (
        SELECT CASE WHEN method_id <> 3 THEN method_id END AS seq, {PAY_PIECE} AS part FROM {PAY_ROWS})) GROUP BY 1, 2""")
def payment_text_of_one_order(t):
    """All payments on one order, under six numbers that repeat and one that is missing."""
    number = F.when(F.col("method_id") != 3, F.col("method_id"))
    return agg.payment_text(typed_payments(t).withColumns({"order_id": F.lit(1), "payment_id": number}), part_size=1000)


@query("inc_06_since_from_stored", """
    SELECT CAST(max(ts) - INTERVAL 48 HOURS AS STRING) AS since_ts FROM events UNION ALL
    SELECT CAST(max(o_orderdate) - INTERVAL 5 MINUTES AS STRING) FROM orders UNION ALL
    SELECT '2024-01-23 00:00:00'""")
def since_from_stored(t):
    """Starts taken from the footers of stored tables; the last table is not there."""
    out = []
    for table, ts, buffer in ((t.events, "ts", "INTERVAL 48 HOURS"), (t.orders, "o_orderdate", "INTERVAL 5 MINUTES")):
        path = scratch_path(t.spark, "loaded")
        table.withColumns({"load_us": slices.micros(ts), "part": F.date_format(ts, "yyyyMM")}).write.partitionBy("part").parquet(path)
        out.append(inc.since_from_stored(t.spark, path, "load_us", buffer))
    nothing = inc.since_from_stored(t.spark, scratch_path(t.spark, "nothing"), "load_us", "INTERVAL 48 HOURS", "2024-02-01 00:00:00")
    return out[0].unionByName(out[1]).unionByName(nothing)


class Broken(Exception):
    pass


@query("inc_03_logged_loads", """
    WITH n AS (SELECT CAST(ceil(count(*) / 3) AS BIGINT) AS n FROM events), placed AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS p FROM events)
    SELECT 'events' AS job_name, 1 AS run, 'SUCCESS' AS status, CAST(ts AS STRING) AS watermark_ts, event_id AS watermark_id, p AS row_count, CAST(NULL AS STRING) AS error, 
           p AS loaded FROM placed, n WHERE p = n UNION ALL
    SELECT 'events', 2, 'FAIL', NULL, NULL, NULL, 'disk full', n FROM n UNION ALL
    SELECT 'events', 3, 'SUCCESS', CAST(ts AS STRING), event_id, p - n, NULL, p FROM placed, n WHERE p = (SELECT count(*) FROM events)""")
def logged_loads(t):
    """A capped load, one that fails, and one that goes on from the log."""
    log, table = scratch_path(t.spark, "log"), scratch_path(t.spark, "events")
    size, loaded = -(-t.events.count() // 3), []

    def write(rows):
        rows.write.mode("append").parquet(table)

    def fail(rows):
        raise Broken("disk full")

    for run, (load, cap) in enumerate(((write, size), (fail, size), (write, None)), 1):
        state = inc.current_watermark(mg.read_or_empty(t.spark, log, RUN_LOG)).first()
        since = (state["watermark_ts"], state["watermark_id"]) if state else ("2000-01-01 00:00:00", 0)
        part = slices.slice_since(t.events, "ts", "event_id", *since, max_rows=cap)
        try:
            inc.logged_load(part, "ts", "event_id", load, log, "events", f"2024-03-0{run} 00:00:00")
        except Broken:
            pass
        loaded.append(t.spark.read.parquet(table).count())
    runs = t.spark.read.schema(RUN_LOG).parquet(log).withColumn("run", F.dayofmonth("started_at"))
    held = t.spark.createDataFrame(list(enumerate(loaded, 1)), "run int, loaded bigint")
    return runs.join(held, "run").select("job_name", "run", "status", "watermark_ts", "watermark_id", "row_count", "error", "loaded")


FLAGGED = """
    SELECT odoo_id AS move_line_id, write_date AS write_ts, CAST(qty AS DOUBLE) AS qty_done, file AS source_file, count(*) AS lines,
           CAST(count(*) - CASE WHEN file = min(file) OVER (PARTITION BY odoo_id, write_date, qty) THEN 1 ELSE 0 END AS BIGINT) AS flagged
    FROM (SELECT *, 'a' AS file FROM (""" + EXTRACT_SQL + """) WHERE write_date < '1999-01-01' UNION ALL SELECT *, 'b' FROM (""" + EXTRACT_SQL + """) WHERE write_date >= '1997-01-01')
    GROUP BY odoo_id, write_date, qty, file"""


@query("ds_07_flags_across_loads", FLAGGED)
def flags_across_loads(t):
    """Two loads whose days overlap: copies in the second one are flagged by what the first has left in its state."""
    extract = mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=2922)
    seen, rows = None, []
    for name, cond in (("a", "write_date < '1999-01-01'"), ("b", "write_date >= '1997-01-01'")):
        loaded = mv.stg_move_line_after(extract.filter(cond).withColumn("source_file", F.lit(name)), AS_OF, seen)
        rows.append(loaded["rows"])
        seen = cut_lineage(loaded["seen"])
    return rows[0].unionByName(rows[1]).groupBy("move_line_id", "write_ts", "qty_done", "source_file").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("dup_flag").alias("flagged"),
    )


@query("str_03_stream_dedup_lookback", "SELECT event_id, user_id, event_type, CAST(ts AS STRING) AS ts, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events")
def stream_dedup_lookback(t):
    """Deliveries of some days each, then all of them again: the table is split by day, and looked at for two days back
    in full, before that through the keys of the batch."""
    box, table, state = (scratch_path(t.spark, n) for n in ("inbox", "table", "checkpoint"))
    events = t.events.select("event_id", "user_id", "event_type", "ts", F.col("ts").cast("date").alias("day"))
    for from_, to in (("2024-01-01", "2024-01-20"), ("2024-01-10", "2024-02-01"), ("2024-01-01", "2024-02-01")):
        events.filter(F.col("day").between(from_, to)).coalesce(1).write.mode("append").parquet(box)
    source = stream.stream_inbox(t.spark, box, events.schema, files_per_trigger=1, fmt="parquet")
    stream.stream_dedup(source, table, state, ["event_id"], ["ts"], "day", lookback_days=2).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(table).select(*events.columns)


@query("ds_06_recent_move_lines", EXTRACT_SQL.replace("1994-01-01", "1999-07-16"))
def recent_move_lines(t):
    """The last 900 days alone."""
    return extract_columns(mv.extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=900))


LATEST_ENTRIES = ENTRIES_SQL.replace("FROM entries", """FROM (
      SELECT *, row_number() OVER (PARTITION BY movement_day, move_line_id, side, location_id
             ORDER BY write_ts DESC NULLS LAST, product_id DESC, qty DESC) AS rn FROM entries) WHERE rn = 1""")


@query("ds_08_stored_by_month", LATEST_ENTRIES)
def stored_by_month(t):
    """The fact stored up to 1999 with zero quantities, then the rest and new versions; read back from the table."""
    path = scratch_path(t.spark, "movement")
    before = mv.fct_stock_movement(t.staged, t.location, rules(t), "2000-01-01 00:00:00", to_day="1999-12-31")
    mv.store_movements(before.withColumn("qty", F.lit(0).cast("decimal(16,4)")), path)
    mv.store_movements(mv.fct_stock_movement(t.staged, t.location, rules(t), AS_OF), path)
    return t.spark.read.schema(before.withColumn("month", F.lit("")).schema).parquet(path).select(*ENTRY_COLUMNS)


OPENINGS = " UNION ALL ".join(f"SELECT * FROM ({QUERIES['ds_09_stock_opening'][1].replace('2001-12-31', day)})" for day in ("2001-12-29", "2001-12-30", "2001-12-31"))


@query("ds_09_openings_by_day")
def openings_by_day(t):
    """Three days stored, the middle one first with what is excluded, then again in its place; read back."""
    path = scratch_path(t.spark, "opening")
    quants = t.quant_raw.select(
        m2o_id("product_id").alias("product_id"), m2o_id("location_id").alias("location_id"), "quantity", parse_dt("in_date").alias("in_date"),
    )
    products = t.product.select("product_id", F.col("name_raw").alias("display_name"), "sale_ok", F.col("cost").alias("standard_price"), F.col("price").alias("lst_price"))
    schema = None
    for day, excluded in (("2001-12-30", []), ("2001-12-29", [8, 16]), ("2001-12-31", [8, 16]), ("2001-12-30", [8, 16])):
        opening = stock.fct_stock_opening(quants, t.location, products, day, excluded_locations=excluded, keywords=("small", "ring", "bolt"), untracked=("brand#2",))
        schema = opening.schema
        stock.store_opening(opening, path, day)
    return t.spark.read.schema(schema).parquet(path).select(*schema.names)


QUERIES["ds_09_openings_by_day"] = (QUERIES["ds_09_openings_by_day"][0], OPENINGS)


@query("ds_14_expenses_by_day", f"""
    SELECT expense_id, expense_date, employee_name, CASE WHEN expense_date >= '1997-01-01' THEN total_amount ELSE -1 END AS total_amount, status
    FROM ({EXPENSE_LATEST.replace("date END AS expense_date", "date[1:8] || '01' END AS expense_date")}) WHERE expense_date IS NOT NULL AND (write_date < '1999-01-01 00:00:00' OR expense_date >= '1997-01-01')""")
def expenses_by_day(t):
    """Expenses on the first of their month: old amounts stored for all days, then a purge and reload from 1997 on; read back."""
    path, raw = scratch_path(t.spark, "expense"), latest_expenses(t)
    raw = raw.withColumn("date", F.when(F.col("date") == "false", F.col("date")).otherwise(F.concat(F.substring("date", 1, 8), F.lit("01"))))
    old = old_expenses(t, raw)
    ex.store_expenses(old, path, "1900-01-01")
    ex.store_expenses(ex.fct_expense(raw, AS_OF), path, "1997-01-01")
    return t.spark.read.schema(old.schema).parquet(path).select(*EXPENSE_COLUMNS)


LINE_VERSIONS = """
    SELECT line_id, order_id, product_id, qty, price_unit, created_at, pos_reference FROM (SELECT *, row_number() OVER (
        PARTITION BY line_id, created_at ORDER BY product_id DESC, qty DESC, price_unit DESC) AS rn FROM (
      SELECT l_orderkey * 8 + l_linenumber AS line_id, l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000000 ELSE 0 END AS order_id,
           l_partkey AS product_id, l_quantity AS qty, l_extendedprice AS price_unit, CAST(l_shipdate AS STRING) AS created_at,
           CASE WHEN l_linenumber = 7 THEN 'INCONNU' ELSE 'Order ' || CAST(l_orderkey AS STRING) END AS pos_reference
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00')) WHERE rn = 1"""


@query("ds_11_lines_over_earlier_ones", LINE_VERSIONS)
def lines_over_earlier_ones(t):
    """Half the lines are stored without quantity and price; all lines are loaded over them, ids that repeat in time too."""
    loaded = staged_lines(t)
    keys = ["line_id", "created_at"]
    before = dedup_latest(loaded["lines"], keys, "created_at", ["product_id", "qty", "price_unit", "discount_percent", "subtotal_incl_tax"]).filter("line_id % 2 = 0")
    stale = before.withColumns({"qty": F.lit(0).cast("decimal(16,4)"), "price_unit": F.lit(0).cast("decimal(16,4)"), "pos_reference": F.lit("old")})
    hours = int((datetime(2002, 1, 1) - datetime(1996, 1, 1)).total_seconds() // 3600)
    again = pos.stg_pos_line(
        t.order_line_raw, t.order_raw, exact_payments(t), AS_OF, {"lines": cut_lineage(stale), "payment_texts": cut_lineage(loaded["payment_texts"].limit(0))}, hours,
    )
    return again["lines"].select("line_id", "order_id", "product_id", "qty", "price_unit", "created_at", "pos_reference")


@query("ds_11_lines_with_payment_text", f"""
    WITH {PAID}, texts AS (SELECT order_id, string_agg(part, ' | ' ORDER BY id, part) AS payment_text FROM (
         SELECT order_id, id, coalesce(method_name, 'PM_' || CAST(method_id AS STRING)) || ': ' || {PLAIN.format(c='amount')} AS part FROM paid) GROUP BY 1)
    SELECT l_orderkey * 8 + l_linenumber AS line_id, l_partkey AS product_id, CASE WHEN l_linenumber = 7 THEN 'NON PAYÉ' ELSE payment_text END AS payment_method_name
    FROM lineitem JOIN texts ON order_id = l_orderkey WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'""")
def lines_with_payment_text(t):
    loaded = staged_lines(t)
    return pos.with_payment_text(loaded["lines"], loaded["payment_texts"]).select("line_id", "product_id", "payment_method_name")


def one_pass(t):
    return pos.load_pos_hist(t.order_raw, t.order_line_raw, exact_payments(t), *HIST, AS_OF)


@query("ds_12_one_pass_lines")
def one_pass_lines(t):
    """All four tables of the history load, written by one job from sources that are scanned once."""
    return one_pass(t)["lines"].select("line_id", "product_id", "method_id", "payment_method_name", "pos_reference")


@query("ds_12_one_pass_orders")
def one_pass_orders(t):
    return one_pass(t)["orders"].select("order_id", "session_id", "config_id", "txn_ts", "employee_id", "amount_total", "pos_reference")


for _name in ("lines", "orders"):
    QUERIES[f"ds_12_one_pass_{_name}"] = (QUERIES[f"ds_12_one_pass_{_name}"][0], QUERIES[f"ds_12_pos_history_{_name}"][1])


@query("ds_12_lines_over_their_own", """
    SELECT line_id, product_id, qty, created_at FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY created_at DESC, product_id DESC, qty DESC) AS rn FROM (
      SELECT l_orderkey * 8 + l_linenumber AS line_id, l_partkey AS product_id, l_quantity AS qty, CAST(l_shipdate AS STRING) AS created_at
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2000-01-01')) WHERE rn = 1""")
def lines_over_their_own(t):
    """The history loaded over an earlier load of itself: ids that repeat leave their latest version."""
    first = pos.load_pos_hist(t.order_raw, t.order_line_raw, exact_payments(t), *HIST, AS_OF)
    keys = {"orders": ("order_id", "write_ts"), "lines": ("line_id", "created_at"), "payments": ("payment_id", "write_ts")}
    stale = {k: dedup_latest(first[k], [key], ts, []).filter(F.col(key) % 2 == 0) for k, (key, ts) in keys.items()}
    again = pos.load_pos_hist(t.order_raw, t.order_line_raw, exact_payments(t), *HIST, AS_OF, targets=stale)
    return again["lines"].select("line_id", "product_id", "qty", "created_at")
