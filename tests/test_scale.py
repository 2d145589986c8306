"""Plans and skew: what must hold whatever the amount of data."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks.registry import run
from comptoir.operators import aggregates as agg
from comptoir.operators import joins as jn
from comptoir.operators import windows as win
from comptoir.operators.positions import with_positions
from comptoir.operators.skew import row_salt, splittable_join
from comptoir.functions.records import parse_dt
from comptoir.plans import movements as mv
from comptoir.plans import pos, stock
from comptoir.session import scratch_path
from comptoir.sources import slices
from tests.conftest import SF, plan, rows


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    old = {}

    def set_all(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            old[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_all
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark):
    """Rows of which a third share one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, 60_000, 1, 12).select(key.alias("k"), F.col("id").alias("v"))


def read_keys(df):
    """Final plan after the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


SPLIT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_hot_key_is_split_against_a_scan(hot, conf):
    conf(**SPLIT)
    heads = hot.select("k").distinct().select("k", (F.col("k") + 1).alias("w"))
    path = heads.sparkSession.conf.get("spark.checkpoint.dir") + "/heads"
    heads.write.mode("overwrite").parquet(path)
    assert "skew=true" in read_keys(jn.attach_order(hot, heads.sparkSession.read.parquet(path), "k"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split_against_a_grouped_side(hot, conf, how):
    conf(**SPLIT)
    grouped = hot.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = splittable_join(hot, grouped, "k", how)
    assert "skew=true" in read_keys(joined)
    assert joined.count() == (0 if how == "left_anti" else 60_000)


def test_small_grouped_side_is_still_broadcast(hot):
    few = hot.filter("v < 100").groupBy("k").count()
    assert "BroadcastHashJoin" in read_keys(splittable_join(hot, few, "k"))


def test_every_row_of_a_hot_group_is_kept(hot):
    out = agg.duplicates(hot, ["k"])
    assert out.count() == 20_000
    assert out.select("occurrences").distinct().collect()[0][0] == 20_000


def test_group_values_reach_every_group(spark):
    df = spark.range(100).selectExpr("nullif(id % 7, 3) AS k", "id")
    groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = rows(splittable_join(df, groups, ["k"], null_safe=True))
    assert len(got) == 100 and sorted(r[2] for r in got if r[0] is None) == [14] * 14
    assert rows(splittable_join(df, groups, ["k"])) == rows(df.join(groups, "k"))


def test_duplicates_keep_missing_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (5, 4), (6, 5)], "k int, v int")
    assert rows(agg.duplicates(df, ["k"]).select("k", "v", "occurrences")) == [(None, 1, 2), (None, 2, 2), (5, 3, 2), (5, 4, 2)]


def test_copies_are_salted_apart(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit("same").alias("k"))
    per_salt = [r[1] for r in copies.groupBy(row_salt(["k"], 16).alias("s")).count().collect()]
    assert len(per_salt) > 4 and max(per_salt) < 2000


def test_one_first_row_per_key_among_copies(spark):
    copies = spark.range(0, 3000, 1, 30).selectExpr("cast(id % 3 AS string) AS k", "cast(0 AS int) AS t")
    flagged = win.flag_duplicates(copies, ["k"], ["t"], salts=8)
    assert rows(flagged.groupBy("k").agg(F.sum(1 - F.col("dup_flag")))) == [("0", 1), ("1", 1), ("2", 1)]
    assert flagged.count() == 3000


def test_payment_text_in_parts(spark):
    pays = spark.range(50).selectExpr("1L AS order_id", "id AS payment_id", "concat('m', id) AS method_name", "cast(id AS decimal(16,4)) AS amount")
    whole = " | ".join(f"m{i}: {i}.0" for i in range(50))
    assert rows(agg.payment_text(pays)) == [(1, 0, whole)]
    sizes = [p[2].count(" | ") + 1 for p in rows(agg.payment_text(pays, part_size=13))]
    assert sizes == [13, 13, 13, 11]
    parts = rows(agg.payment_text(pays, part_size=10))
    assert [p[1] for p in parts] == [0, 1, 2, 3, 4]
    assert " | ".join(p[2] for p in parts) == whole


def test_payment_text_of_one_order_with_repeated_and_missing_numbers(spark):
    """100,000 payments of one order: exact positions, and no more than a part in one value."""
    pays = spark.range(0, 100_000, 1, 8).selectExpr(
        "7L AS order_id", "if(id % 3 = 0, NULL, if(id % 3 = 1, 5L, id)) AS payment_id", "'m' AS method_name", "cast(id AS decimal(16,4)) AS amount"
    )
    want = sorted(range(100_000), key=lambda i: (i % 3 == 0, 5 if i % 3 == 1 else i if i % 3 else 0, f"m: {i}.0"))
    got = rows(agg.payment_text(pays, part_size=1000))
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == list(range(100)) and {r[2].count(" | ") for r in got} == {999}
    assert " | ".join(r[2] for r in got) == " | ".join(f"m: {i}.0" for i in want)


@pytest.mark.parametrize("partitions", [1, 5])
def test_positions(spark, partitions):
    """Groups of all sizes, missing groups, whole rows that repeat."""
    df = spark.range(0, 4000, 1, partitions).selectExpr("if(id % 3 = 0, NULL, if(id % 3 = 1, 'hot', concat('g', id % 50))) AS g", "cast(id % 97 AS int) AS v")
    got = with_positions(df, ["g"], ["v"], "at", "of")
    assert got.columns == ["g", "v", "at", "of"]
    found = {}
    for g, v, at, of in got.collect():
        found.setdefault((g, of), []).append((at, v))
    assert sum(map(len, found.values())) == 4000 and len({g for g, _ in found}) == len(found)
    for (_, of), members in found.items():
        members.sort()
        assert [at for at, _ in members] == list(range(of)) and [v for _, v in members] == sorted(v for _, v in members)
    assert with_positions(df.limit(0), ["g"], ["v"]).count() == 0


def test_lines_with_payment_text(spark):
    lines = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "line_id int, order_id int")
    texts = spark.createDataFrame([(10, 1, "b: 2.0"), (10, 0, "a: 1.0")], "order_id int, part int, payment_text string")
    got = pos.with_payment_text(lines, texts).select("line_id", "payment_method_name")
    assert rows(got) == [(1, "a: 1.0 | b: 2.0"), (2, "a: 1.0 | b: 2.0"), (3, "NON PAYÉ")]


def test_numbering_a_period_equals_one_global_numbering(spark):
    df = spark.range(200).selectExpr("date_add(DATE '2024-01-01', cast(id % 9 AS int)) AS day", "cast(id AS string) AS shop")
    order = [r.shop for r in df.orderBy("day", "shop").collect()]
    got = {r.numero: r.shop for r in win.numbered(df, ["shop"], period=True).collect()}
    assert got == {i + 1: shop for i, shop in enumerate(order)}


def test_latest_row_is_chosen_before_the_shuffle(tables):
    text = plan(win.dedup_latest(tables.lineitem, ["l_orderkey"], "l_shipdate", ["l_partkey"]))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


def test_slices_reach_the_scan(tables):
    text = plan(slices.slice_since(tables.events, "ts", "event_id", "2024-01-15 00:00:00", 0).select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan(slices.slice_range(tables.orders, "o_orderdate", "1996-01-01", "1997-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


RAW_SLICES = {
    "move lines": ("line_raw", "write_date", lambda t, raw: mv.extract_move_lines(raw, t.priced_product, "2002-01-01")),
    "line staging": ("order_line_raw", "create_date", lambda t, raw: pos.stg_pos_line(raw, t.order_raw, t.payment_raw, "2002-01-01")["lines"]),
    "history": ("order_line_raw", "create_date", lambda t, raw: pos.pos_hist(t.order_raw, raw, t.payment_raw, "2001-01-01", "2002-01-01", "2002-01-01")["lines"]),
    "sessions": ("session_raw", "write_date", lambda t, raw: pos.fct_pos_session(raw, "2002-01-01")),
    "quants": ("quant_raw", "write_date", lambda t, raw: stock.stg_quant(raw, t.location, "2001-01-01 00:00:00", 0, "2002-01-01")),
}


@pytest.mark.parametrize("name", list(RAW_SLICES))
def test_slices_on_text_reach_the_scan(spark, tables, name):
    table, text, run = RAW_SLICES[name]
    path = scratch_path(spark, "raw")
    getattr(tables, table).limit(200).write.parquet(path)
    assert re.search(rf"PushedFilters: \[[^\]]*GreaterThanOrEqual\({text},", plan(run(tables, spark.read.parquet(path))))


def test_text_bounds_lose_nothing(spark):
    times = ["2024-01-05 10:00:00", " 2024-01-06 00:00:00", "2024-01-05 09:59:59", "2024-01-05 10:00:01 ", "bad", None, ""]
    df = spark.createDataFrame([(t,) for t in times], "raw string").withColumn("at", parse_dt("raw"))
    for at in ("2024-01-05 10:00:00", "2024-01-05 10:00:00.5", "2024-01-05"):
        for inclusive in (True, False):
            plain = slices.slice_last(df, "at", at, inclusive=inclusive)
            assert rows(slices.slice_last(df, "at", at, inclusive=inclusive, text="raw")) == rows(plain)
        assert rows(slices.slice_range(df, "at", "2024-01-05 10:00:00", at, "raw")) == rows(slices.slice_range(df, "at", "2024-01-05 10:00:00", at))


def test_capped_slice_is_a_filter(tables):
    """Nothing is sorted or gathered; the end of the slice reaches the scan."""
    text = plan(slices.slice_since(tables.events, "ts", "event_id", "2024-01-15 00:00:00", 0, max_rows=10))
    assert "TakeOrderedAndProject" not in text and "Exchange" not in text and "Sort" not in text
    assert "LessThanOrEqual(ts," in text


@pytest.mark.parametrize("few", [4096, 3])
@pytest.mark.parametrize("n", [1, 7, 250, 251, 400, 999, 1000, 1001])
def test_capped_slice_by_time_then_id(spark, monkeypatch, n, few):
    """Many ids at one time, repeated pairs, missing ids: the first n pairs, and all rows that share the last one."""
    monkeypatch.setattr(slices, "FEW", few)
    monkeypatch.setattr(slices, "BINS", 16)
    df = spark.range(1000).selectExpr(
        "if(id % 100 = 99, NULL, if(id < 500, id * 1000003, id div 2)) AS k",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, cast(if(id < 250, 0, if(id < 400, id * 7919.000001, 0.000001)) AS decimal(18, 6))) AS ts", "id",
    )
    least = -(1 << 62)
    pairs = sorted((r.ts, least if r.k is None else r.k, r.id) for r in df.collect() if r.ts > datetime(2023, 12, 31))
    want = pairs if n >= len(pairs) else [p for p in pairs if p[:2] <= pairs[n - 1][:2]]
    got = slices.slice_since(df, "ts", "k", "2023-12-31 00:00:00", 0, max_rows=n)
    assert sorted(r.id for r in got.collect()) == sorted(p[2] for p in want)


WRITES = ("src_", "str_", "mrg_", "jn_16", "ds_03")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(WRITES)])
def test_no_query_multiplies_out_or_leaves_the_jvm(name, spark, monkeypatch):
    text = plan(run(name, spark, SF))
    assert "CartesianProduct" not in text
    assert "Python" not in text and "MapInPandas" not in text
    if "BroadcastNestedLoopJoin" in text:
        assert name == "jn_08_rule_table_classification"
