"""Merges, incremental state, quality checks and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import query
from comptoir.operators import incremental as inc
from comptoir.operators import merge as mg
from comptoir.operators import quality as dq
from comptoir.operators.windows import dedup_latest
from comptoir.session import cut_lineage, scratch_path
from comptoir.streaming import inbox as stream

KEY = ["l_orderkey", "l_linenumber"]
COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "made"]


def old_and_new(t, part=False):
    """Latest line per key up to 1999, and per key from 1997 on, with holes in the flag."""
    made = F.col("l_shipdate").cast("date")
    lines = t.lineitem.withColumn("made", made)
    if part:
        lines = lines.withColumn("part", F.year("made"))
    seq = ["l_partkey", "l_quantity", "l_suppkey", "l_extendedprice"]
    keys = KEY + (["part"] if part else [])
    cols = COLUMNS + (["part"] if part else [])
    old = dedup_latest(lines.filter(made < "2000-01-01"), keys, "made", seq).select(cols)
    new = dedup_latest(lines.filter(made >= "1997-01-01"), keys, "made", seq).select(cols)
    hole = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag")
    return old, new.withColumn("l_returnflag", hole)


LATEST = """(SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {flag} AS l_returnflag, CAST(l_shipdate AS DATE) AS made{extra} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber{by} ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC,
           l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE l_shipdate {cond}) WHERE rn = 1)"""


def sides(part=False):
    by, extra = (", year(l_shipdate)", ", year(l_shipdate) AS part") if part else ("", "")
    old = LATEST.format(flag="l_returnflag", cond="< TIMESTAMP '2000-01-01'", by=by, extra=extra)
    new = LATEST.format(flag="CASE WHEN l_returnflag <> 'N' THEN l_returnflag END", cond=">= TIMESTAMP '1997-01-01'", by=by, extra=extra)
    return old, new


def merged_sql(updated: dict[str, str], part=False) -> str:
    """Full outer join; ``updated`` maps a column to its value on a match."""
    old, new = sides(part)
    on = "n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber" + (" AND n.part = o.part" if part else "")
    cols = []
    for c in ["l_partkey", "l_quantity", "l_returnflag", "made"]:
        on_match = updated.get(c, f"o.{c}")
        value = f"CASE WHEN o.l_orderkey IS NULL THEN n.{c} WHEN n.l_orderkey IS NULL THEN o.{c} ELSE {on_match} END"
        cols.append((f"CAST({value} AS STRING)" if c == "made" else value) + f" AS {c}")
    if part:
        cols.append("coalesce(n.part, o.part) AS part")
    return f"""SELECT coalesce(n.l_orderkey, o.l_orderkey) AS l_orderkey, coalesce(n.l_linenumber, o.l_linenumber) AS l_linenumber,
        {', '.join(cols)} FROM {old} o FULL JOIN {new} n ON {on}"""


ALL = {c: f"n.{c}" for c in ["l_partkey", "l_quantity", "l_returnflag"]}


@query("mrg_01_upsert", merged_sql(ALL))
def upsert(t):
    old, new = old_and_new(t)
    return mg.upsert(old, new, KEY, insert_only=["made"])


@query("mrg_01_upsert_small_batch", merged_sql(ALL))
def upsert_small_batch(t):
    old, new = old_and_new(t)
    return mg.upsert(old, new, KEY, insert_only=["made"], delta=True)


@query("mrg_02_upsert_some_columns", merged_sql({"l_quantity": "n.l_quantity"}))
def upsert_some_columns(t):
    old, new = old_and_new(t)
    return mg.upsert(old, new, KEY, update_cols=["l_quantity"])


@query("mrg_03_upsert_never_erase", merged_sql({**ALL, "made": "n.made", "l_returnflag": "coalesce(n.l_returnflag, o.l_returnflag)"}))
def upsert_never_erase(t):
    old, new = old_and_new(t)
    return mg.upsert(old, new, KEY, keep_if_null=["l_returnflag"])


@query("mrg_04_merge_touched_partitions", merged_sql({**ALL, "made": "n.made"}, part=True))
def merge_touched_partitions(t):
    """The stored form: only the years the batch brings are rewritten."""
    path = scratch_path(t.spark, "table")
    old, new = old_and_new(t, part=True)
    mg.overwrite_parts(old, path, "part")
    mg.store(t.spark, path, new, "part", lambda target, batch: mg.upsert(target, batch, KEY + ["part"]))
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query("mrg_04_same_batch_twice", merged_sql({**ALL, "made": "n.made"}, part=True))
def same_batch_twice(t):
    """A batch that is stored again changes nothing."""
    path = scratch_path(t.spark, "table")
    old, new = old_and_new(t, part=True)
    mg.overwrite_parts(old, path, "part")
    for _ in range(2):
        mg.store(t.spark, path, new, "part", lambda target, batch: mg.upsert(target, batch, KEY + ["part"]))
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query("mrg_04_partial_batch", merged_sql({"l_returnflag": "n.l_returnflag"}, part=True))
def partial_batch(t):
    """A batch without some of the table's columns leaves them as they are, and empty on new rows."""
    path = scratch_path(t.spark, "table")
    old, new = old_and_new(t, part=True)
    mg.overwrite_parts(old, path, "part")
    some = new.select(*KEY, "part", "l_partkey", "l_quantity", "made", "l_returnflag")
    mg.store(
        t.spark, path, some, "part",
        lambda target, batch: mg.upsert(target, batch, KEY + ["part"], update_cols=["l_returnflag"]),
    )
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query("mrg_04_repeated_keys", merged_sql({**ALL, "made": "n.made"}, part=True))
def repeated_keys(t):
    """A batch that holds every row twice is stored as one that holds it once, given an order."""
    path = scratch_path(t.spark, "table")
    old, new = old_and_new(t, part=True)
    mg.overwrite_parts(old, path, "part")
    keys = KEY + ["part"]
    mg.store(
        t.spark, path, new.unionByName(new), "part",
        lambda target, batch: mg.upsert(target, dedup_latest(batch, keys, "made", ["l_partkey"]), keys),
    )
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query("mrg_05_retire_missing", """
    SELECT product_id, name_norm, is_current AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = product_id
             AND l_shipdate >= TIMESTAMP '2001-06-01') AS is_current FROM {product}""")
def retire_missing(t):
    present = t.lineitem.filter(F.col("l_shipdate") >= "2001-06-01").select(F.col("l_partkey").alias("product_id"))
    return mg.retire_missing(t.product.select("product_id", "name_norm", "is_current"), present, "product_id")


@query("mrg_06_append", """
    SELECT l_orderkey, l_linenumber, l_partkey, 'old' AS batch FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, 'new' FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'""")
def append(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    old = lines.filter(F.col("l_shipdate") < "1998-01-01").withColumn("batch", F.lit("old"))
    new = lines.filter(F.col("l_shipdate") >= "1997-01-01").withColumn("batch", F.lit("new"))
    return mg.append(old, new).drop("l_shipdate")


@query("mrg_07_reload_window", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'old' ELSE 'new' END AS batch FROM lineitem""")
def reload_window(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    old, new = (lines.withColumn("batch", F.lit(b)) for b in ("old", "new"))
    return mg.reload_window(old, new, "day", "1999-01-01").drop("day")


@query("mrg_08_replace_day", """
    SELECT opening_date || '' AS opening_date, product_id, location_id, CAST(opening_qty AS DOUBLE) *
           CASE WHEN opening_date = DATE '1998-01-05' THEN 10 ELSE 1 END AS opening_qty FROM {opening}""")
def replace_day(t):
    held = t.opening.select("opening_date", "product_id", "location_id", "opening_qty")
    tenfold = (F.col("opening_qty") * 10).cast("decimal(16,4)")
    return mg.replace_day(held, held.withColumn("opening_qty", tenfold), "opening_date", "1998-01-05")


@query("mrg_10_purge_from", """
    SELECT id, date FROM {expense_raw} WHERE date = 'false' OR CAST(CASE WHEN date = 'false' THEN NULL ELSE date END AS DATE) < DATE '1998-01-01'""")
def purge_from(t):
    dated = t.expense_raw.select("id", "date", F.col("date").try_cast("date").alias("day"))
    return mg.purge_from(dated, "day", "1998-01-01").drop("day")


@query("mrg_11_retention", """
    SELECT l_orderkey, l_linenumber, 'day' AS kind FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '2000-01-15' - 900 UNION ALL
    SELECT l_orderkey, l_linenumber, 'month' FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def retention(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    by_day = mg.apply_retention(lines, "day", "2000-01-15", keep_days=900).withColumn("kind", F.lit("day"))
    by_month = mg.apply_retention(lines, "day", "2000-01-15", keep_months=24).withColumn("kind", F.lit("month"))
    return by_day.unionByName(by_month).drop("day")


@query("mrg_11_drop_old_partitions", """
    SELECT l_orderkey, l_linenumber, year(l_shipdate) AS part FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def drop_old_partitions(t):
    path = scratch_path(t.spark, "table")
    mg.overwrite_parts(t.lineitem.select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("part")), path, "part")
    mg.drop_old_parts(t.spark, path, "part", "1998")
    return t.spark.read.parquet(path).select("l_orderkey", "l_linenumber", "part")


# ---- incremental -----------------------------------------------------------------

STATE = """
    WITH last AS (SELECT job_name, max_by(lookback_sec, started_at) AS lb, arg_max_null(lookback_sec, started_at) AS lookback_sec FROM {runs} GROUP BY 1),
    top AS (SELECT job_name, max((coalesce(watermark_ts, TIMESTAMP '2000-01-01'), coalesce(watermark_id, 0))) AS p FROM {runs}
            WHERE status = 'SUCCESS' AND (watermark_ts IS NOT NULL OR watermark_id IS NOT NULL) GROUP BY 1),
    state AS (SELECT last.job_name, 'ts' AS watermark_type, p[1] AS watermark_ts, p[2] AS watermark_id,
              coalesce(lookback_sec, 7200) AS lookback_sec FROM last JOIN top ON top.job_name = last.job_name)"""


@query("inc_01_current_watermark", STATE + """
    SELECT job_name, watermark_type, CAST(watermark_ts AS STRING) AS watermark_ts, watermark_id, lookback_sec FROM state""")
def current_watermark(t):
    return inc.current_watermark(t.runs)


@query("inc_02_run_history", """
    SELECT job_name, runs, CAST(started_at AS STRING) AS last_run_started, CAST(ended_at AS STRING) AS last_run_ended,
           status AS last_run_status, row_count AS last_run_rows, CASE WHEN status = 'FAIL' THEN left(error, 4000) END AS last_error
    FROM (SELECT *, count(*) OVER (PARTITION BY job_name) AS runs, row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC) AS rn FROM {runs})
    WHERE rn = 1""")
def run_history(t):
    return inc.run_history(t.runs)


@query("inc_03_advance", STATE + """
    SELECT job_name, CAST(CASE WHEN n > 2000 AND new > old THEN new[1] ELSE old[1] END AS STRING) AS watermark_ts,
           CASE WHEN n > 2000 AND new > old THEN new[2] ELSE old[2] END AS watermark_id FROM (
      SELECT s.job_name, (watermark_ts, watermark_id) AS old, n, (ts, id) AS new FROM state s JOIN (
        SELECT event_type, count(*) AS n, max(ts) FILTER (WHERE user_id < 50) AS ts, max(event_id) AS id FROM events GROUP BY 1) e
      ON e.event_type = s.job_name)""")
def advance(t):
    reached = t.events.groupBy(F.col("event_type").alias("job_name")).agg(
        F.max(F.when(F.col("user_id") < 50, F.col("ts"))).alias("new_ts"), F.max("event_id").alias("new_id"),
        F.when(F.count(F.lit(1)) > 2000, inc.SUCCESS).otherwise(inc.FAIL).alias("status"),
    )
    return inc.advance(inc.current_watermark(t.runs), reached).select("job_name", "watermark_ts", "watermark_id")


@query("inc_04_lookback", STATE + """
    SELECT job_name, CAST(watermark_ts - to_seconds(lookback_sec) AS STRING) AS since_ts FROM state""")
def lookback(t):
    return inc.since(inc.current_watermark(t.runs)).select("job_name", "since_ts")


@query("inc_05_resolve_since", STATE + """,
    since AS (SELECT job_name, watermark_ts - to_seconds(lookback_sec) AS s, watermark_id FROM state)
    SELECT 'incremental' AS mode, job_name, CAST(greatest(s, TIMESTAMP '2024-01-29 12:00:00') AS STRING) AS since_ts,
           CASE WHEN s < TIMESTAMP '2024-01-29 12:00:00' THEN 0 ELSE watermark_id END AS since_id FROM since UNION ALL
    SELECT 'full_catchup', job_name, '2024-01-29 12:00:00', 0 FROM since""")
def resolve_since(t):
    state = inc.current_watermark(t.runs)
    modes = [
        inc.resolve_since(state, mode, "2024-01-29 12:00:00").select(F.lit(mode).alias("mode"), "job_name", "since_ts", "since_id")
        for mode in ("incremental", "full_catchup")
    ]
    return modes[0].unionByName(modes[1])


@query("inc_06_since_from_target", """
    SELECT CAST(max(ts) - INTERVAL 48 HOURS AS STRING) AS since_ts FROM events UNION ALL
    SELECT CAST(max(o_orderdate) - INTERVAL 5 MINUTES AS STRING) FROM orders""")
def since_from_target(t):
    a = inc.since_from_target(t.events, "ts", "INTERVAL 48 HOURS", "2024-02-01 00:00:00")
    b = inc.since_from_target(t.orders, "o_orderdate", "INTERVAL 5 MINUTES")
    return a.unionByName(b)


@query("inc_07_backfill", """
    SELECT d || '' AS day, count(l_orderkey) AS rows FROM
      (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
      LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = d GROUP BY d""")
def backfill(t):
    lines = t.lineitem.withColumn("day", F.col("l_shipdate").cast("date"))
    return inc.backfill(lines, "day", "1994-12-01", "2001-12-31")[1]


# ---- quality ----------------------------------------------------------------------


@query("dq_01_reconciliation", """
    WITH prev AS (SELECT l_suppkey AS k, sum(CAST(l_quantity AS DECIMAL(16,4))) AS q FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1),
    curr AS (SELECT l_suppkey AS k, sum(CAST(l_quantity AS DECIMAL(16,4))) AS q FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1),
    moved AS (SELECT l_suppkey AS k, sum(CAST(l_quantity AS DECIMAL(16,4))) AS q FROM lineitem
              WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag <> 'N' GROUP BY 1)
    SELECT location_id, CAST(coalesce(prev.q, 0) AS DOUBLE) AS open_qty_prev, CAST(coalesce(moved.q, 0) AS DOUBLE) AS in_qty, CAST(0 AS DOUBLE) AS out_qty,
           CAST(coalesce(moved.q, 0) AS DOUBLE) AS net_movement, CAST(coalesce(prev.q, 0) + coalesce(moved.q, 0) AS DOUBLE) AS closing_qty,
           CAST(coalesce(curr.q, 0) AS DOUBLE) AS open_qty_curr,
           CAST(coalesce(curr.q, 0) - coalesce(prev.q, 0) - coalesce(moved.q, 0) AS DOUBLE) AS variance
    FROM {location} LEFT JOIN prev ON prev.k = location_id LEFT JOIN curr ON curr.k = location_id LEFT JOIN moved ON moved.k = location_id""")
def reconciliation(t):
    qty = F.col("l_quantity").cast("decimal(16,4)")
    at = F.col("l_shipdate")
    lines = t.lineitem.withColumnRenamed("l_suppkey", "location_id")
    prev = lines.filter(at < "1998-01-01").groupBy("location_id").agg(F.sum(qty).alias("open_qty_prev"))
    curr = lines.filter(at < "1999-01-01").groupBy("location_id").agg(F.sum(qty).alias("open_qty_curr"))
    year = lines.filter((at >= "1998-01-01") & (at < "1999-01-01") & (F.col("l_returnflag") != "N"))
    moved = year.groupBy("location_id").agg(
        F.sum(qty).alias("in_qty"), F.lit(0).cast("decimal(16,4)").alias("out_qty"), F.sum(qty).alias("net_movement")
    )
    return dq.stock_situation(t.location.select("location_id"), prev, curr, moved)


@query("dq_02_missing_days", """
    SELECT d || '' AS day FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-15', TIMESTAMP '2002-01-15', INTERVAL 1 DAY)) AS DATE) AS d)
    WHERE d NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def missing_days(t):
    return dq.missing_days(t.lineitem, "l_shipdate", "1994-12-15", "2002-01-15")


@query("dq_02_missing_months", """
    SELECT d || '' AS month FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-06-01', TIMESTAMP '2002-06-01', INTERVAL 1 MONTH)) AS DATE) AS d)
    WHERE d NOT IN (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem)""")
def missing_months(t):
    return dq.missing_months(t.lineitem, "l_shipdate", "1994-06-20", "2002-06-10")


@query("dq_03_negative_stock", """
    SELECT opening_date || '' AS opening_date, product_id, location_id, CAST(opening_qty AS DOUBLE) AS opening_qty
    FROM {opening} WHERE opening_qty < 0""")
def negative_stock(t):
    return dq.negative_stock(t.opening, "opening_qty").select("opening_date", "product_id", "location_id", "opening_qty")


@query("dq_04_report_status", """
    SELECT family, CAST(CAST(max(o_orderdate) AS DATE) AS STRING) AS newest,
           CASE WHEN max(o_orderdate) IS NULL THEN 'MISSING' WHEN CAST(max(o_orderdate) AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders
                WHERE o_orderpriority = '2-HIGH') THEN 'FRESH' ELSE 'STALE' END AS status
    FROM (SELECT unnest(['1-URGENT', '2-HIGH', '5-LOW', '6-NONE']) AS family) LEFT JOIN orders ON o_orderpriority = family GROUP BY 1""")
def report_status(t):
    newest = t.orders.filter("o_orderpriority = '2-HIGH'").agg(F.max("o_orderdate").cast("date").alias("d")).first()["d"]
    outputs = t.orders.select(F.col("o_orderpriority").alias("family"), F.col("o_orderdate").alias("report_day"))
    return dq.report_status(outputs, newest, ["1-URGENT", "2-HIGH", "5-LOW", "6-NONE"])


# ---- streams ------------------------------------------------------------------------


@query("str_01_inbox_stream", "SELECT event_id, user_id, event_type, props FROM events")
def inbox_stream(t):
    """Events land as gzipped JSON files in two deliveries; each is taken once."""
    box, table, state = (scratch_path(t.spark, n) for n in ("inbox", "table", "checkpoint"))
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, props STRING"
    events = t.events.select("event_id", "user_id", "event_type", "props")
    early = t.events["ts"] < "2024-01-15"
    for delivery in (events.filter(early), events.filter(~early)):
        delivery.write.mode("append").json(box, compression="gzip")
        stream.append_stream(stream.stream_inbox(t.spark, box, schema), table, state).awaitTermination()
    return t.spark.read.schema(schema).parquet(table)


@query("str_02_streaming_upsert", """
    SELECT user_id, month, event_id, CAST(ts AS STRING) AS ts, event_type FROM (SELECT *, month(ts) AS month,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def streaming_upsert(t):
    """Last event per user, merged from a file stream in several batches."""
    box, table, state = (scratch_path(t.spark, n) for n in ("inbox", "table", "checkpoint"))
    events = t.events.select("user_id", F.month("ts").alias("month"), "event_id", "ts", "event_type")
    events.repartition(3, "event_type").write.parquet(box)
    source = stream.stream_inbox(t.spark, box, events.schema, files_per_trigger=1, fmt="parquet")
    stream.stream_upsert(source, table, state, "month", ["user_id", "month"], "ts", ["event_id"]).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(table).select(*events.columns)


@query("str_03_stream_dedup", "SELECT event_id, user_id, event_type, CAST(ts AS STRING) AS ts FROM events")
def stream_dedup(t):
    """Every event is delivered twice, the newest first, a file at a time; one copy of each comes through."""
    box, table, state = (scratch_path(t.spark, n) for n in ("inbox", "table", "checkpoint"))
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    age = F.ntile(5).over(Window.orderBy(F.col("ts").desc(), "event_id"))
    dealt = cut_lineage(events.withColumn("delivery", age))
    for delivery in (1, 2, 3, 4, 5, 1):  # the first comes once more at the end
        part = dealt.filter(F.col("delivery") == delivery).drop("delivery")
        (part if delivery == 1 else part.unionByName(part)).coalesce(1).write.mode("append").parquet(box)
    source = stream.stream_inbox(t.spark, box, events.schema, files_per_trigger=1, fmt="parquet")
    stream.stream_dedup(source, table, state, ["event_id"], ["ts"]).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(table)
