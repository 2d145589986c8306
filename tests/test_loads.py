"""What one load leaves for the next: files, logs, state; and what a load may not do."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from comptoir.operators import incremental as inc
from comptoir.operators import merge as mg
from comptoir.operators import windows as win
from comptoir.schemas import RUN_LOG
from comptoir.session import scratch_path
from comptoir.sources import slices
from comptoir.streaming import inbox as stream
from tests.conftest import plan, rows


@pytest.mark.parametrize("delta", [False, True])
@pytest.mark.parametrize("read", [lambda df: df.count(), lambda df: df.select("k").collect(), lambda df: df.agg(F.max("k")).collect(), lambda df: df.filter("k = 5").count()])
def test_no_plan_does_without_the_check_for_repeated_keys(spark, delta, read):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (5, "c")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (5, "x"), (5, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        read(mg.upsert(target, twice, ["k"], delta=delta))


def test_missing_keys_are_spread_and_stay(spark):
    """A third of both sides without a key: all rows stay, and no task of the join has them all."""
    half = lambda v: spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id) AS k", "id", f"'{v}' AS v", "map('a', id) AS m")
    merged = mg.upsert(half("old"), half("new"), ["k"])
    assert rows(merged.groupBy(F.col("k").isNull(), "v").count()) == [(False, "new", 20_000), (True, "new", 10_000), (True, "old", 10_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    per_task = [r[1] for r in merged.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) == 4 and max(per_task) < 10_000


def stored(spark, path, schema="k int, v string, part int"):
    return spark.read.schema(schema).parquet(path)


def names(spark, path):
    return {"/".join(f.split("/")[-2:]) for f in stored(spark, path).inputFiles()}


def upsert_part(target, batch):
    return mg.upsert(target, batch, ["k", "part"])


def test_a_batch_of_one_key_rewrites_one_file(spark):
    path = scratch_path(spark, "t")
    spark.range(0, 1000, 1, 5).selectExpr("cast(id AS int) AS k", "'old' AS v", "cast(id % 2 AS int) AS part").write.partitionBy("part").parquet(path)
    before = names(spark, path)
    assert len(before) == 10
    batch = spark.createDataFrame([(700, "new", 0), (-1, "added", 0)], "k int, v string, part int")
    assert mg.store_by_file(spark, path, batch, "part", ["k", "part"], upsert_part)["replaced"] == 1
    after = names(spark, path)
    assert len(before - after) == 1 and len(after & before) == 9
    got = {r.k: r.v for r in stored(spark, path).collect()}
    assert len(got) == 1001 and got[700] == "new" and got[-1] == "added" and got[699] == "old"
    # new keys alone replace nothing; a table that is not there is made
    assert mg.store_by_file(spark, path, spark.createDataFrame([(5000, "x", 1)], batch.schema), "part", ["k", "part"], upsert_part) == {"replaced": 0, "written": 1}
    fresh = scratch_path(spark, "t")
    mg.store_by_file(spark, fresh, batch, "part", ["k", "part"], upsert_part)
    assert rows(stored(spark, fresh)) == [(-1, "added", 0), (700, "new", 0)]


@pytest.mark.parametrize("steps", range(5))
def test_a_store_that_breaks_off_is_completed(spark, monkeypatch, steps):
    """Broken off after any of its first steps behind the intent, and then run again."""
    path, schema = scratch_path(spark, "t"), "k int, v string, part int"
    spark.range(0, 40, 1, 2).selectExpr("cast(id AS int) AS k", "'old' AS v", "cast(id % 2 AS int) AS part").write.partitionBy("part").parquet(path)
    batch = spark.createDataFrame([(3, "new", 1), (4, "new", 0), (99, "new", 1)], schema)
    true_system = mg.file_system

    class Breaking:
        def __init__(self, fs, root):
            self.fs, self.left = fs, steps

        def __getattr__(self, name):
            if name in ("delete", "rename") and armed["on"]:
                if not self.left:
                    raise OSError("broken off")
                self.left -= 1
            return getattr(self.fs, name)

    armed = {"on": False}

    def breaking(spark_, where):
        fs, root = true_system(spark_, where)
        return (Breaking(fs, root), root) if armed["on"] else (fs, root)

    true_complete = mg.complete_store

    def complete(spark_, where):
        armed["on"] = fs_has_intent(spark_, where)
        try:
            return true_complete(spark_, where)
        finally:
            armed["on"] = False

    def fs_has_intent(spark_, where):
        fs, _ = true_system(spark_, where)
        return fs.exists(mg._hadoop(spark_, f"{where}/{mg.INTENT}"))

    monkeypatch.setattr(mg, "file_system", breaking)
    monkeypatch.setattr(mg, "complete_store", complete)
    try:
        mg.store_by_file(spark, path, batch, "part", ["k", "part"], upsert_part)
    except OSError:
        pass
    monkeypatch.undo()
    mg.store_by_file(spark, path, batch, "part", ["k", "part"], upsert_part)
    want = {i: "new" if i in (3, 4) else "old" for i in range(40)} | {99: "new"}
    got = rows(stored(spark, path).select("k", "v"))
    assert got == sorted(want.items(), key=lambda x: str(x[0]))


def test_the_latest_write_comes_from_footers(spark):
    path = scratch_path(spark, "t")
    ts = F.timestamp_ntz("2024-01-01") if hasattr(F, "timestamp_ntz") else F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    spark.range(100).select(ts.alias("ts"), "id", (F.col("id") % 3).alias("part")).withColumn("load_us", slices.micros("ts") + F.col("id")).write.partitionBy("part").parquet(path)
    assert "PushedAggregation: [MAX(load_us)]" in plan(inc.footer_max(spark, path, "load_us"))
    got = inc.since_from_stored(spark, path, "load_us", "INTERVAL 1 HOUR").first()["since_ts"]
    assert got == datetime(2023, 12, 31, 23, 0, 0, 99)
    assert inc.since_from_stored(spark, scratch_path(spark, "no"), "load_us", "INTERVAL 0 HOURS").first()["since_ts"] == datetime(2000, 1, 1)


def test_a_load_is_logged_and_its_rows_are_read_once(spark):
    log, table, read = scratch_path(spark, "log"), scratch_path(spark, "t"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.range(10).selectExpr("id", "if(id = 9, NULL, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id / 4 AS int))) AS ts")
    row = inc.logged_load(source.mapInArrow(counted, source.schema), "ts", "id", lambda df: df.write.parquet(table), log, "j", "2024-02-01 00:00:00")
    assert read.value == 10 and (row.watermark_ts, row.watermark_id, row.row_count) == (datetime(2024, 1, 3), 8, 10)

    def fails(df):
        raise RuntimeError("x" * 9000)

    with pytest.raises(RuntimeError):
        inc.logged_load(source, "ts", "id", fails, log, "j", "2024-02-02 00:00:00")
    inc.logged_load(source.limit(0), "ts", "id", lambda df: df.write.mode("append").parquet(table), log, "j", "2024-02-03 00:00:00")
    runs = spark.read.schema(RUN_LOG).parquet(log)
    assert rows(runs.select("status", "watermark_id", F.length("error"))) == [("FAIL", None, 4000), ("SUCCESS", None, None), ("SUCCESS", 8, None)]
    assert rows(inc.current_watermark(runs).select("watermark_ts", "watermark_id")) == [(datetime(2024, 1, 3), 8)]


def test_flags_across_loads_equal_one_load(spark):
    """Loads in order, and one that comes late with earlier rows; missing keys and order values."""
    schema = "k string, at int, name string, i int"
    all_rows = [(k, at, n, i) for i, (k, at, n) in enumerate([("a", 1, "x"), ("a", 2, "x"), (None, 1, "x"), ("b", 5, None), ("b", 5, "x"), (None, 3, "x"), ("c", 9, "x"), ("a", 1, "x"), ("c", None, "x"), ("d", 4, "y"), ("d", 2, "y")])]
    order = ["at", "name"]
    for loads in ([all_rows[:4], all_rows[4:7], all_rows[7:]], [all_rows[7:], all_rows[:7]]):
        seen, got, demoted = None, {}, set()
        for load in loads:
            out = win.flag_across_loads(spark.createDataFrame(load, schema), seen, ["k"], order)
            for r in out["demoted"].collect():
                hit = [i for k, at, n, i in all_rows if (k, at, n) == (r.k, r.at, r.name) and got.get(i) == 0]
                got.update(dict.fromkeys(hit, 1))
            got.update({r.i: r.dup_flag for r in out["rows"].collect()})
            seen = spark.createDataFrame(out["seen"].collect(), out["seen"].schema)
        once = {r.i: r.dup_flag for r in win.flag_duplicates(spark.createDataFrame(all_rows, schema), ["k"], order).collect()}
        firsts = lambda flags: sorted(((k, at, n) for k, at, n, i in all_rows if not flags[i]), key=str)
        assert firsts(got) == firsts(once) and sum(got.values()) == sum(once.values())


def test_membership_reads_the_days_back_and_the_rest_by_key(spark):
    path, schema = scratch_path(spark, "t"), "k int, at int, day date"
    spark.range(1000).selectExpr("cast(id AS int) AS k", "0 AS at", "date_add(date'2024-01-01', cast(id / 10 AS int)) AS day").write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(5, 1, datetime(2024, 4, 5).date()), (980, 1, datetime(2024, 4, 5).date()), (2000, 1, datetime(2024, 4, 6).date()), (None, 1, datetime(2024, 4, 6).date())], schema)
    known = stream.known_keys(spark.read.schema(schema).parquet(path), batch, ["k"], "day", 2)
    assert {5, 980} <= {r.k for r in known.collect()} and known.count() < 60
    text = plan(known)
    assert "GreaterThanOrEqual(k,5)" in text and "LessThanOrEqual(k,2000)" in text and "day#" in text.split("PartitionFilters", 1)[1][:200]
    for _ in range(2):
        stream.append_new(path, ["k"], ["at"], "day", 2)(batch, 0)
    table = spark.read.schema(schema).parquet(path)
    assert table.count() == 1002 and rows(table.filter("k IS NULL OR k > 1000").select("k")) == [(None,), (2000,)]


def test_history_load_leaves_only_its_tables(spark):
    """the three staged sources and the shuffles of the history load stayed on disk beside the written tables."""
    from pathlib import Path

    from checks import run
    from comptoir.session import shared_dir

    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {p for d in local for p in Path(d).rglob("shuffle_*.data")}
    cuts = lambda: set(Path(shared_dir(spark).removeprefix("file:")).glob("cut-*"))
    before, staged = shuffles(), cuts()
    got = run("ds_12_lines_over_their_own", spark, "/root/testdata/sf0.001")
    assert cuts() <= staged
    assert shuffles() <= before
    assert got.count() > 0


def test_line_payload_is_made_after_the_order_join(spark):
    """The lines shuffled to their orders carry their raw columns alone: typed columns and payload come after."""
    from comptoir.plans import pos

    lines = spark.range(1, 2).selectExpr(
        "id", "concat('[', id + 6, ',\"O\"]') AS order_id", "concat('[', id + 2, ',\"P\"]') AS product_id", "2.0D AS qty", "5.0D AS price_unit", "0.0D AS discount",
        "10.0D AS price_subtotal", "12.5D AS price_subtotal_incl", "'2001-01-01 00:00:00' AS create_date", "'2001-01-02 00:00:00' AS write_date",
    )
    heads = spark.range(7, 8).selectExpr("id AS order_id", "4L AS config_id", "timestamp_ntz'2001-01-01 00:00:00' AS txn_ts", "date'2001-01-01' AS txn_day")
    products = spark.range(3, 4).selectExpr("id AS product_id", "'b3' AS barcode")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = pos.fct_pos_line(lines, heads, products, "2002-01-01 00:00:00")
        text = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("StructsToJson") < text.rindex("Join"), text
    [row] = got.collect()
    assert (row.order_id, row.line_id, row.barcode, row.config_id) == (7, 1, "b3", 4)
    assert row.payload.startswith('{"order_id":[7,"O"],"product_id":[3,"P"],"id":1,'), row.payload


def test_a_cut_leaves_no_shuffle_files(spark):
    """the shuffles of a lineage cut stayed on disk beside its files until the driver collected its garbage."""
    from pathlib import Path

    from comptoir.session import SHUFFLE_CLEANUP, cut_lineage

    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {p for d in local for p in Path(d).rglob("shuffle_*.data")}
    before = shuffles()
    held = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffles() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) is None
    assert held.count() == 7


def test_a_versioned_source_is_shuffled_once(spark):
    """choosing the latest version, the check and the join each grouped the source anew."""
    target = spark.createDataFrame([(1, 1, "a"), (5, 1, "e"), (None, 9, "n"), (None, 9, "n")], "k long, at int, p string")
    source = spark.createDataFrame([(1, 2, "b"), (1, 3, "c"), (1, 3, "d"), (2, 1, "f"), (None, 1, "g"), (None, 2, "h")], target.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = mg.upsert(target, source, ["k"], latest=("at", ["p"]))
        apart = mg.upsert(target, win.dedup_latest(source, ["k"], "at", ["p"]), ["k"])
        assert plan(merged).count("Exchange") == 2 < plan(apart).count("Exchange")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(merged) == rows(apart) == [(None, 2, "h"), (None, 9, "n"), (None, 9, "n"), (1, 3, "d"), (2, 1, "f"), (5, 1, "e")]


def test_history_load_finds_its_records_once(spark, monkeypatch):
    """F1, F2, F4, F8, F9: the staged orders and payments were looked up by the lines again, payloads and all, for every branch."""
    from comptoir.plans import pos

    looked_up = []
    monkeypatch.setattr(pos, "restrict_to", lambda df, *a, f=pos.restrict_to: looked_up.append(df.columns) or f(df, *a))
    at = "'2001-01-01 00:00:00'"
    lines = spark.range(1, 4).selectExpr("id", "concat('[', id, ',\"O\"]') AS order_id", "'[3,\"P\"]' AS product_id", "2.0D AS qty", "5.0D AS price_unit", "0.0D AS discount", "12.5D AS price_subtotal_incl", f"{at} AS create_date")
    false = ", ".join(f"'false' AS {c}" for c in ("pos_reference", "uuid", "session_id", "config_id", "employee_id", "partner_id"))
    orders = spark.range(2, 9).selectExpr(
        "id", "concat('Order ', id) AS name", *false.split(", "), f"{at} AS date_order", f"{at} AS write_date", *[f"1.0D AS amount_{x}" for x in ("tax", "total", "paid", "return")], "'paid' AS state")
    payments = spark.range(1, 9).selectExpr("id", "concat('[', id, ',\"O\"]') AS pos_order_id", "'[1,\"Cash\"]' AS payment_method_id", "4.0D AS amount", "false AS is_change", *[f"{at} AS {c}" for c in ("payment_date", "create_date", "write_date")])
    got = pos.load_pos_hist(orders, lines, payments, "2001-01-01", "2002-01-01", "2002-01-01 00:00:00")
    assert len(looked_up) == 2 and not any("payload" in columns for columns in looked_up)
    assert rows(got["orders"].select("order_id", F.get_json_object("payload", "$.name"))) == [(2, "Order 2"), (3, "Order 3")]
    assert rows(got["payments"].select("payment_id", "amount", F.get_json_object("payload", "$.amount").cast("double"))) == [(i, 4, 4) for i in (1, 2, 3)]
    assert rows(got["lines"].select("line_id", "payment_method_name", "pos_reference")) == [(1, "Cash: 4.0", None), (2, "Cash: 4.0", "Order 2"), (3, "Cash: 4.0", "Order 3")]
    assert got["rejected_payments"].count() == 0


def test_a_store_merges_some_partitions_at_a_time(spark, monkeypatch):
    """one merge held the batch, the table and the new files in shuffles at once."""
    monkeypatch.setattr(mg, "MERGE_ROWS", 4)
    path, keys, schema = scratch_path(spark, "t"), ["k", "part"], "k int, v int, part string"
    old = [(k, 0, p) for p in ("a", "b", "c", None) for k in range(3)]
    new = [(k, 1, p) for p in ("b", "c", "d", None) for k in range(1, 5)]
    merged = []

    def merge(target, batch):
        merged.append({r.part for r in batch.select("part").distinct().collect()})
        return mg.upsert(target, batch, keys)

    for batch in (old, new):
        mg.store_by_file(spark, path, spark.createDataFrame(batch, schema), "part", keys, merge)
    assert merged == [{None}, {"a"}, {"b"}, {"c"}] + [{None}, {"b"}, {"c"}, {"d"}]
    want = {(k, p): v for k, v, p in old if p} | {(k, p): v for k, v, p in new if p}
    nulls = [(k, v, p) for k, v, p in old + new if p is None]
    assert rows(spark.read.schema(schema).parquet(path)) == sorted([(k, v, p) for (k, p), v in want.items()] + nulls, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_only_keys_of_very_many_rows_are_ranked_in_parts(spark, monkeypatch):
    """all rows were shuffled twice so that one key of very many rows would be no hot task."""
    df = spark.range(600).selectExpr("if(id < 200, 'big', if(id < 400, NULL, concat('k', id div 2))) AS k", "cast(id % 50 AS int) AS at", "id")
    want = [("big", 0), (None, 0), *[(f"k{i}", 0) for i in range(200, 300)]]
    parts = []
    monkeypatch.setattr(win, "_flag_in_parts", lambda df, *a, f=win._flag_in_parts: parts.append(df) or f(df, *a))
    for hot, ranked in ((100, 400), (100_000, 0)):
        monkeypatch.setattr(win, "HOT", hot)
        flagged = win.flag_duplicates(df, ["k"], ["at", "id"])
        assert parts.pop().count() == ranked and flagged.count() == 600
        first = flagged.filter("dup_flag = 0").select("k", "at", "id").collect()
        assert sorted(((r.k, 0) for r in first), key=str) == sorted(want, key=str)
        assert {(r.at, r.id) for r in first if r.k in (None, "big")} == {(0, 0), (0, 200)}


def test_partitions_written_in_turn_are_those_written_at_once(spark, monkeypatch):
    """a reload shuffled all its days together."""
    monkeypatch.setattr(mg, "MERGE_ROWS", 100)
    df = spark.range(1000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 40 AS int)) AS day")
    held = {}
    for in_turn in (False, True):
        path = scratch_path(spark, "t")
        mg.overwrite_parts(df.selectExpr("id - 5000 AS id", "date_add(day, 20) AS day"), path, "day")
        jobs = []
        monkeypatch.setattr(mg, "_in_turn", lambda *a, f=mg._in_turn: jobs.extend(f(*a)) or jobs)
        mg.overwrite_parts(df, path, "day", in_turn)
        monkeypatch.undo()
        monkeypatch.setattr(mg, "MERGE_ROWS", 100)
        assert (len(jobs) > 4) == in_turn
        held[in_turn] = rows(spark.read.parquet(path))
    assert held[True] == held[False] and len(held[True]) == 1500
