"""Scans, slices, sinks, filters and sorts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from comptoir.functions import records as r
from comptoir.operators import filters as flt
from comptoir.operators import merge
from comptoir.operators import windows as win
from comptoir.plans.movements import extract_move_lines
from comptoir.session import scratch_path
from comptoir.sources import files, scans, slices

EVENTS_AS_OF = "2024-01-15 00:00:00"
NAMES = tuple(f"BOUTIQUE | SUPPLIER#{k:09d}" for k in (1, 4, 7, 10, 13, 16, 19, 22, 25, 28)) + ("DEPOT | CENTRAL | SUPPLIER#000000000",)
NAMES_SQL = ", ".join(f"'{n}'" for n in NAMES)

EXTRACT_SQL = """
    SELECT l_orderkey * 8 + l_linenumber AS odoo_id, l_partkey AS product_id, l_suppkey + 1 AS location_dest_id,
           l_quantity AS qty, 'Units' AS uom, CAST(l_shipdate AS STRING) AS write_date, barcode,
           list_price AS unit_sale_price, coalesce(standard_price, 0) AS unit_cost,
           CASE WHEN l_linestatus <> 'O' THEN l_returnflag || l_linestatus || '/' || CAST(l_orderkey AS STRING)
                WHEN l_returnflag <> 'N' THEN 'REF/' || CAST(l_orderkey AS STRING) END AS ref
    FROM lineitem LEFT JOIN {priced_product} p ON p.id = l_partkey
    WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'O') AND l_shipdate > TIMESTAMP '1994-01-01 00:00:00'"""


def written_extract(t) -> str:
    """Every finished move line, written as one gzipped extract; returns the inbox."""
    inbox = scratch_path(t.spark, "inbox")
    since = datetime(1994, 1, 1)
    lines = extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=(datetime(2002, 1, 1) - since).days)
    files.write_extract(lines, inbox, datetime(2002, 1, 1), since)
    return inbox


def extract_columns(df):
    return df.select(
        "odoo_id", "product_id", "location_dest_id", "qty", "uom", "write_date", "barcode", "unit_sale_price",
        "unit_cost", r.json_path("raw", "$.movement_ref").alias("ref"),
    )


@query("src_01_move_line_files", EXTRACT_SQL)
def move_line_files(t):
    inbox = written_extract(t)
    return extract_columns(files.read_move_lines(t.spark, f"{inbox}/stock_move_line_*"))


@query("src_02_latest_file", EXTRACT_SQL + " AND l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'")
def latest_file(t):
    inbox = scratch_path(t.spark, "inbox")
    since = datetime(1994, 1, 1)
    lines = extract_move_lines(t.line_raw, t.priced_product, datetime(2002, 1, 1), days=(datetime(2002, 1, 1) - since).days)
    old = F.col("write_date") < "1998-01-01"
    files.write_extract(lines.filter(old), inbox, datetime(2001, 1, 1), since)
    files.write_extract(lines.filter(~old), inbox, datetime(2002, 1, 1), since)
    return extract_columns(files.read_move_lines(t.spark, files.latest_file(t.spark, inbox), partitions=8))


@query("src_03_extract_manifest", """
    SELECT 'stock.move.line' AS model, '2002-01-01 00:00:00' AS created_at_utc, '1994-01-01 00:00:00' AS extract_since_utc,
           true AS filter_done, count(*) AS rows, 'stock_move_line_20020101_000000' AS data_file
    FROM (""" + EXTRACT_SQL + ")")
def extract_manifest(t):
    schema = "model STRING, created_at_utc STRING, extract_since_utc STRING, filter_done BOOLEAN, rows BIGINT, data_file STRING"
    return t.spark.read.schema(schema).json(f"{written_extract(t)}/manifests/*")


@query("src_04_slice_since", f"""
    SELECT event_id, CAST(ts AS STRING) AS ts, user_id FROM events
    WHERE ts > TIMESTAMP '{EVENTS_AS_OF}' OR (ts = TIMESTAMP '{EVENTS_AS_OF}' AND event_id > 0)""")
def slice_since(t):
    return slices.slice_since(t.events, "ts", "event_id", EVENTS_AS_OF, 0).select("event_id", "ts", "user_id")


@query("src_05_slice_last", """
    SELECT id, state, write_date FROM {line_raw}
    WHERE CAST(write_date AS TIMESTAMP) > TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 500 DAYS AND state = 'done'""")
def slice_last(t):
    at = t.line_raw.withColumn("at", r.parse_dt("write_date"))
    return slices.slice_last(at, "at", "1998-01-01 00:00:00", days=500, state_col="state").select("id", "state", "write_date")


@query("src_06_slice_range", """
    SELECT o_orderkey, CAST(o_orderdate AS STRING) AS o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'""")
def slice_range(t):
    bounds = slices.range_bounds("hist", datetime(2002, 1, 1), from_=datetime(1996, 1, 1), to=datetime(2000, 1, 1))
    return slices.slice_range(t.orders, "o_orderdate", *bounds).select("o_orderkey", "o_orderdate")


@query("src_07_read_dimension", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def read_dimension(t):
    return scans.read_dim(t.spark, f"{t.sf_dir}/supplier.parquet", ["s_suppkey", "s_name", "s_nationkey"])


@query("src_08_scan_in_scope", """
    SELECT move_line_id, location_id, CAST(qty_done AS DOUBLE) AS qty_done FROM {staged} s
    WHERE qty_done > 0 AND EXISTS (SELECT 1 FROM {location} l
          WHERE l.location_id = s.location_id AND l.usage IN ('internal', 'inventory'))""")
def scan_in_scope(t):
    return scans.scan_in_scope(t.staged, t.location, ["internal", "inventory"], positive="qty_done").select(
        "move_line_id", "location_id", "qty_done"
    )


@query("src_09_keep_existing", "SELECT c_custkey, c_name FROM customer")
def keep_existing(t):
    return scans.keep_existing(t.customer, ["c_custkey", "c_fax", "c_name", "c_mobile"])


@query("src_10_first_available", """
    SELECT id, CASE WHEN cash_journal_id <> 'false' THEN c_nationkey END AS journal_id, CAST(NULL AS STRING) AS nothing
    FROM {method_raw} JOIN customer ON c_custkey = id""")
def first_available(t):
    methods = t.method_raw
    return methods.select(
        "id", r.m2o_id(scans.first_available(methods)).alias("journal_id"),
        scans.first_available(methods, ["no_such_column"]).alias("nothing"),
    )


@query("src_11_payload", """
    SELECT s_suppkey, '{{"s_suppkey":' || CAST(s_suppkey AS STRING) || ',"s_name":"' || s_name || '","s_nationkey":'
           || CAST(s_nationkey AS STRING) || '}}' AS payload FROM supplier""")
def payload(t):
    return scans.with_payload(t.supplier.drop("s_acctbal")).select("s_suppkey", "payload")


@query("src_12_audit_csv", "SELECT o_orderkey, CAST(o_orderdate AS STRING) AS o_orderdate, o_orderstatus FROM orders")
def audit_csv(t):
    path = scratch_path(t.spark, "audit")
    at = t.orders.select(F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderkey", "o_orderstatus")
    files.write_audit(at, path, "o_orderdate", "o_orderkey")
    return t.spark.read.schema("o_orderkey BIGINT, o_orderdate STRING, o_orderstatus STRING").option("header", True).csv(path)


@query("src_13_partitioned_table", """
    SELECT move_line_id, product_id, side, CAST(movement_day AS STRING) AS movement_day,
           year(movement_day) * 100 + month(movement_day) AS part_month
    FROM {movement} WHERE movement_day BETWEEN DATE '1995-01-10' AND DATE '2001-10-20'""")
def partitioned_table(t):
    path = scratch_path(t.spark, "movement")
    moves = t.movement.select("move_line_id", "product_id", "side", "movement_day")
    files.write_partitioned(moves, path, "movement_day", "month")
    stored = files.read_day_range(t.spark, path, "movement_day", datetime(1995, 1, 10).date(), datetime(2001, 10, 20).date())
    return stored.select("move_line_id", "product_id", "side", "movement_day", "part_month")


@query("src_14_report_dataset", """
    SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, year(o_orderdate) * 100 + month(o_orderdate) AS report_month,
           count(*) AS orders, sum(o_custkey) AS check_sum
    FROM orders GROUP BY 1, 2""")
def report_dataset(t):
    path = scratch_path(t.spark, "report")
    by_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_custkey").alias("check_sum")
    )
    # a first, wrong issue of some months is replaced by the second; other months stay
    wrong = by_day.withColumn("orders", F.lit(-1).cast("bigint"))
    late = F.col("day") >= "1999-01-01"
    files.write_report(wrong.filter(late).unionByName(by_day.filter(~late)), path, "day")
    files.write_report(by_day.filter(late), path, "day")
    return t.spark.read.parquet(path).select("day", "report_month", "orders", "check_sum")


@query("flt_01_on_day", """
    SELECT move_line_id, product_id, side FROM {movement} WHERE movement_day = DATE '1998-01-01'""")
def on_day(t):
    return flt.on_day(t.movement, "movement_day", "1998-01-01").select("move_line_id", "product_id", "side")


@query("flt_02_named_locations", f"SELECT location_id, name_norm FROM {{location}} WHERE name_norm IN ({NAMES_SQL})")
def named_locations(t):
    return flt.locations_in(t.location, NAMES).select("location_id", "name_norm")


@query("flt_03_excluded_locations", "SELECT move_line_id, location_id FROM {staged} WHERE location_id NOT IN (1, 3, 5)")
def excluded_locations(t):
    return flt.exclude_ids(t.staged, [1, 3, 5]).select("move_line_id", "location_id")


@query("flt_04_incomplete_rows", """
    SELECT count(*) AS total_rows, sum(CASE WHEN write_ts IS NULL OR state IS NULL THEN 1 ELSE 0 END) AS rejected_rows
    FROM {staged}""")
def incomplete_rows(t):
    return flt.rejected_rows(t.staged, ["write_ts", "state"])


@query("flt_04_complete_rows", """
    SELECT move_line_id, product_id, state FROM {staged} WHERE write_ts IS NOT NULL AND state IS NOT NULL""")
def complete_rows(t):
    return flt.drop_incomplete(t.staged, ["write_ts", "state"]).select("move_line_id", "product_id", "state")


@query("flt_05_current_rows", "SELECT product_id, name_norm FROM {product} WHERE is_current")
def current_rows(t):
    return flt.current(t.product).select("product_id", "name_norm")


@query("flt_06_only_exceptions", """
    SELECT product_id, location_id, s1, s2 FROM (
      SELECT product_id, location_id, CASE WHEN opening_qty < 0 THEN 'NEG' ELSE 'OK' END AS s1,
             CASE WHEN unit_cost = 0 THEN 'NOCOST' ELSE 'OK' END AS s2 FROM {opening})
    WHERE s1 <> 'OK' OR s2 <> 'OK'""")
def only_exceptions(t):
    marked = t.opening.select(
        "product_id", "location_id",
        F.when(F.col("opening_qty") < 0, "NEG").otherwise("OK").alias("s1"),
        F.when(F.col("unit_cost") == 0, "NOCOST").otherwise("OK").alias("s2"),
    )
    return flt.only_exceptions(marked, "s1", "s2")


@query("flt_07_nonzero_and_state", """
    SELECT move_line_id, product_id FROM {staged}
    WHERE coalesce(unit_cost, 0) <> 0 AND coalesce(state, '') = 'done'""")
def nonzero_and_state(t):
    return t.staged.filter(flt.nonzero("unit_cost") & flt.in_state("state")).select("move_line_id", "product_id")


@query("so_01_report_order", """
    SELECT CAST(movement_day AS STRING) AS movement_day, side, movement_type, n,
           row_number() OVER (ORDER BY movement_day, movement_type ASC NULLS LAST, side) AS pos
    FROM (SELECT movement_day, side, movement_type, count(*) AS n FROM {movement} GROUP BY ALL)""")
def report_order(t):
    counted = t.movement.groupBy("movement_day", "side", "movement_type").agg(F.count(F.lit(1)).alias("n"))
    placed = win.numbered(counted, ["movement_type", "side"], per="movement_day", period=True, into="pos")
    return win.sorted_report(placed, ["movement_day", "movement_type", "side"])


@query("so_02_descending", """
    SELECT state, n, row_number() OVER (ORDER BY state DESC NULLS FIRST) AS pos FROM (
      SELECT state, count(*) AS n FROM {staged} GROUP BY 1)""")
def descending(t):
    counted = t.staged.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    ordered = win.sorted_report(counted, ["state"], desc=["state"])
    pos = F.row_number().over(win.Window.orderBy(win.pg_desc("state")))
    return ordered.withColumn("pos", pos)


@query("so_03_row_cap", f"""
    SELECT event_id, CAST(ts AS STRING) AS ts FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}'
    ORDER BY ts, event_id LIMIT 2000""")
def row_cap(t):
    return slices.slice_since(t.events, "ts", "event_id", EVENTS_AS_OF, -1, max_rows=2000).select("event_id", "ts")


@query("so_04_top_one", """
    SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1""")
def top_one(t):
    return win.top_one(t.lineitem.select("l_partkey", "l_suppkey"), ["l_partkey"], ["l_suppkey"])


@query("mrg_09_rebuild", "SELECT p_partkey, p_name FROM part")
def rebuild(t):
    path = scratch_path(t.spark, "rebuilt")
    merge.rebuild(t.part.select("p_partkey", F.lit("old").alias("p_name")), path)
    merge.rebuild(t.part.select("p_partkey", "p_name"), path)
    return t.spark.read.parquet(path)
