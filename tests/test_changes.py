"""Merges, tables, watermarks and streams."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from comptoir.functions.measures import as_ts
from comptoir.operators import incremental as inc
from comptoir.operators import merge as mg
from comptoir.schemas import RUN_LOG
from comptoir.session import scratch_path
from comptoir.streaming import inbox as stream
from tests.conftest import rows

SCHEMA = "k int, a string, b string, made string"
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
records = st.dictionaries(st.integers(0, 9), st.tuples(*[st.sampled_from(["x", "y", None])] * 3), max_size=8)


def frame(spark, d):
    return spark.createDataFrame([(k, *v) for k, v in d.items()], SCHEMA)


@FEW
@given(old=records, new=records)
def test_upsert_matches_definition(spark, old, new):
    want = dict(old)
    for k, (a, b, made) in new.items():
        want[k] = (a, b if b is not None else old[k][1], old[k][2]) if k in old else (a, b, made)
    how = dict(keys=["k"], keep_if_null=["b"], insert_only=["made"])
    target, source = frame(spark, old), frame(spark, new)
    merged = mg.upsert(target, source, **how)
    assert {r[0]: tuple(r[1:]) for r in merged.collect()} == want
    assert rows(mg.upsert(target, source, delta=True, **how)) == rows(merged)
    assert rows(mg.upsert(merged, source, **how)) == rows(merged), "a second run changes nothing"


def test_upsert_some_columns(spark):
    target, source = frame(spark, {1: ("a", "b", "m")}), frame(spark, {1: ("A", "B", "M"), 2: ("C", "D", "N")})
    assert rows(mg.upsert(target, source, ["k"], update_cols=["a"])) == [(1, "A", "b", "m"), (2, "C", "D", "N")]


def test_source_without_a_column(spark):
    target = frame(spark, {1: ("a", "b", "m")})
    source = spark.createDataFrame([(1, "A"), (2, "C")], "k int, a string")
    assert rows(mg.upsert(target, source, ["k"], update_cols=["a"])) == [(1, "A", "b", "m"), (2, "C", None, None)]


def test_empty_extract_retires_all(spark):
    target = spark.createDataFrame([(1, True, "o"), (2, False, "o")], "k int, is_current boolean, at string")
    out = mg.retire_missing(target, target.limit(0), "k", stamp="at", as_of=F.lit("now"))
    assert rows(out) == [(1, False, "now"), (2, False, "o")]


def test_retention_cutoffs(spark):
    day = lambda c: spark.range(1).select(c).first()[0]
    assert day(mg.retention_cutoff("2024-05-20", keep_days=90)) == date(2024, 2, 20)
    assert day(mg.retention_cutoff("2024-05-20", keep_months=12)) == date(2023, 5, 1)


def test_undated_rows_survive_purge_and_replacement(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, None), (3, date(2024, 1, 2))], "k int, d date")
    assert rows(mg.purge_from(df, "d", "2024-01-02").select("k")) == [(1,), (2,)]
    assert rows(mg.replace_day(df, df.limit(0), "d", "2024-01-01").select("k")) == [(2,), (3,)]


def test_store_touches_only_its_partitions(spark):
    path = scratch_path(spark, "t")
    schema = "k int, v string, part int"
    merge = lambda t, b: mg.upsert(t, b, ["k", "part"])
    mg.store(spark, path, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), "part", merge)
    files = lambda part: sorted(f for f in spark.read.parquet(f"{path}/part={part}").inputFiles())
    before = files(1)
    mg.store(spark, path, spark.createDataFrame([(2, "B", 2), (3, "c", 3)], schema), "part", merge)
    assert files(1) == before
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "a", 1), (2, "B", 2), (3, "c", 3)]


def test_touched_parts_with_a_missing_one(spark):
    target = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], "k int, part int")
    batch = spark.createDataFrame([(9, 1), (9, 3), (9, None)], "k int, part int")
    assert rows(mg.touched_parts(target, batch, "part").select("k")) == [(1,), (3,), (4,)]


def test_merge_keeps_columns_the_batch_lacks(spark):
    path = scratch_path(spark, "t")
    mg.overwrite_parts(spark.createDataFrame([(1, "a", 7, 1), (2, "b", 8, 1)], "k int, v string, w int, part int"), path, "part")
    batch = spark.createDataFrame([(1, "A", 1), (3, "C", 1)], "k int, v string, part int")
    mg.store(spark, path, batch, "part", lambda t, b: mg.upsert(t, b, ["k", "part"], update_cols=["v"]))
    assert rows(spark.read.parquet(path).select("k", "v", "w")) == [(1, "A", 7), (2, "b", 8), (3, "C", None)]
    with pytest.raises(ValueError):
        mg.store(spark, path, batch, "part", lambda t, b: b)


def test_partition_writes_leave_no_shuffle_files(spark):
    """each write's shuffle held a whole copy of the frame until the driver collected its garbage."""
    from pathlib import Path

    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {p for d in local for p in Path(d).rglob("shuffle_*.data")}
    before = shuffles()
    path = scratch_path(spark, "t")
    df = spark.range(2000).selectExpr("id AS k", "if(id % 7 = 0, NULL, id % 5) AS part")
    mg.overwrite_parts(df, path, "part")
    mg.overwrite_parts(df.filter("k < 10").withColumn("k", F.col("k") + 10000), path, "part")
    assert shuffles() <= before
    assert spark.conf.get(mg.SHUFFLE_CLEANUP, None) is None
    want = sorted({(k,) for k in range(10, 2000) if (None if k % 7 == 0 else k % 5) not in {None if k % 7 == 0 else k % 5 for k in range(10)}} | {(k + 10000,) for k in range(10)})
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k").collect()) == want


def test_writes_by_file_leave_no_shuffle_files(spark):
    """the staged batch and the rewritten files kept their shuffles on disk until the driver collected its garbage."""
    from pathlib import Path

    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {p for d in local for p in Path(d).rglob("shuffle_*.data")}
    before = shuffles()
    path = scratch_path(spark, "t")
    merge = lambda t, b: t.join(b, ["k", "part"], "left_anti").unionByName(b)
    df = spark.range(2000).selectExpr("id AS k", "id % 5 AS part", "id AS v").groupBy("k", "part").agg(F.max("v").alias("v"))
    mg.store_by_file(spark, path, df, "part", ["k", "part"], merge)
    mg.store_by_file(spark, path, df.filter("k < 10").withColumn("v", F.col("v") + 10000), "part", ["k", "part"], merge)
    assert shuffles() <= before
    assert spark.conf.get(mg.SHUFFLE_CLEANUP, None) is None
    want = sorted((k, k + 10000 if k < 10 else k) for k in range(2000))
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == want


def test_a_repeated_key_is_an_error(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        mg.upsert(target, batch, ["k"]).collect()
    missing = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    assert mg.upsert(target, missing, ["k"]).count() == 3


def test_late_files_are_not_lost(spark):
    """Newest first, a file per batch: nothing is too late, and nothing comes twice."""
    from comptoir.streaming import inbox as stream

    box, table, state = (scratch_path(spark, n) for n in ("box", "table", "state"))
    events = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-31' - make_dt_interval(cast(id / 40 AS int)) AS ts")
    for lo in (0, 250, 500, 750, 0):
        events.filter(f"id >= {lo} AND id < {lo + 250}").unionByName(events.filter(f"id = {lo}")).coalesce(1).write.mode("append").parquet(box)
    source = stream.stream_inbox(spark, box, events.schema, files_per_trigger=1, fmt="parquet")
    stream.stream_dedup(source, table, state, ["id"], ["ts"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == list(range(1000))


def test_a_version_without_a_time_is_not_lost(spark):
    from comptoir.streaming import inbox as stream

    path, schema = scratch_path(spark, "t"), "k int, v string, ts timestamp_ntz, part int"
    for v, ts in (("old", T0), ("new", None)):
        stream.merge_batch(path, "part", ["k", "part"], "ts", ["v"])(spark.createDataFrame([(1, v, ts, 1)], schema), 0)
    assert rows(spark.read.schema(schema).parquet(path).select("k", "v")) == [(1, "new")]


def test_reload_parts_drops_emptied_days(spark):
    path = scratch_path(spark, "t")
    made = lambda days: spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, day string")
    read = lambda: sorted({r.day for r in spark.read.schema("k int, day string").parquet(path).collect()})
    assert mg.reload_parts(spark, path, made(["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"]), "day", "2024-01-01") == []
    assert mg.reload_parts(spark, path, made(["2024-01-01", "2024-01-03", "2024-01-04"]), "day", "2024-01-02") == ["2024-01-02", "2024-01-05"]
    assert read() == ["2024-01-01", "2024-01-03", "2024-01-04"]
    assert mg.reload_parts(spark, path, made([]), "day", "2024-01-03", "2024-01-03") == ["2024-01-03"]
    assert mg.reload_parts(spark, path, made([]), "day", "2024-01-01") == ["2024-01-01", "2024-01-04"]


def test_movements_by_month_and_openings_by_day(tables):
    from checks.q_relational import rules
    from comptoir.plans import movements as mv

    path = scratch_path(tables.spark, "fact")
    entries = mv.latest_entries(mv.fct_stock_movement(tables.staged, tables.location, rules(tables), "2002-01-01 00:00:00"))
    mv.store_movements(entries.filter("move_line_id % 3 = 0"), path)
    for _ in range(2):
        mv.store_movements(entries, path)
    stored = tables.spark.read.parquet(path)
    assert stored.count() == entries.count() == stored.select(*mv.MOVEMENT_KEY).distinct().count()


def test_drop_old_parts(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-03-01")], "k int, day string")
    mg.overwrite_parts(df, path, "day")
    assert mg.drop_old_parts(spark, path, "day", "2024-02-01") == ["2024-01-01"]
    assert [r.k for r in spark.read.parquet(path).collect()] == [2]


# ---- watermarks ---------------------------------------------------------------

T0 = datetime(2024, 1, 1)


def run_row(job="j", kind="ts", ts=None, key=None, lookback=None, at=0, status="SUCCESS", rows=1, error=None, enabled=True):
    start = T0 + timedelta(hours=at)
    return (job, kind, ts, key, lookback, start, start, status, rows, error, enabled)


def test_watermark_defaults_and_failures(spark):
    log = spark.createDataFrame(
        [run_row(ts=T0, key=5, at=1), run_row(ts=T0, key=9, at=2), run_row(ts=T0 + timedelta(1), key=1, at=3, status="FAIL"),
         run_row(job="new", status="RUNNING"), run_row(job="off", ts=T0, key=1, enabled=False)],
        RUN_LOG,
    )
    got = {r.job_name: (r.watermark_ts, r.watermark_id, r.lookback_sec) for r in inc.current_watermark(log).collect()}
    assert got == {"j": (T0, 9, 7200), "new": (datetime(2000, 1, 1), 0, 7200)}


def test_unknown_watermark_type(spark):
    log = spark.createDataFrame([run_row(kind="page")], RUN_LOG)
    with pytest.raises(Exception, match="unknown watermark type"):
        inc.current_watermark(log).collect()


def test_history_cuts_errors(spark):
    log = spark.createDataFrame(
        [run_row(at=1, status="FAIL", error="e" * 5000), run_row(job="k", at=1, status="FAIL", error="x"), run_row(job="k", at=2)], RUN_LOG
    )
    got = {r.job_name: (r.last_run_status, r.last_error) for r in inc.run_history(log).collect()}
    assert got == {"j": ("FAIL", "e" * 4000), "k": ("SUCCESS", None)}


@FEW
@given(pairs=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.booleans()), min_size=1, max_size=5))
def test_watermark_never_goes_back(spark, pairs):
    state = spark.createDataFrame([("j", T0, 1)], "job_name string, watermark_ts timestamp_ntz, watermark_id long")
    at = (T0, 1)
    for days, key, ok in pairs:
        reached = spark.createDataFrame([("j", T0 + timedelta(days - 1), key)], "job_name string, new_ts timestamp_ntz, new_id long")
        state = inc.advance(state, reached, inc.SUCCESS if ok else inc.FAIL)
        row = state.first()
        now = (row.watermark_ts, row.watermark_id)
        want = max(at, (T0 + timedelta(days - 1), key)) if ok else at
        assert now == want >= at
        state, at = spark.createDataFrame([("j", *now)], state.schema), now


def test_floor_resets_the_id(spark):
    schema = "job_name string, watermark_ts timestamp_ntz, watermark_id long, lookback_sec long"
    state = spark.createDataFrame([("old", T0, 7, 3600), ("new", T0 + timedelta(9), 8, 3600)], schema)
    got = {r.job_name: (r.since_ts, r.since_id) for r in inc.resolve_since(state, floor="2024-01-05 00:00:00").collect()}
    assert got == {"old": (datetime(2024, 1, 5), 0), "new": (T0 + timedelta(9) - timedelta(hours=1), 8)}


def test_start_from_an_empty_target(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert inc.since_from_target(empty, "t", "INTERVAL 48 HOURS", "2024-01-10 00:00:00").first()[0] == T0
    assert inc.since_from_target(empty, "t", "INTERVAL 5 MINUTES").first()[0] == datetime(2000, 1, 1)


# ---- streams --------------------------------------------------------------------

EVENT = "id long, part int, v string, ts timestamp_ntz"


def deliver(spark, box, records):
    spark.createDataFrame(records, EVENT).coalesce(1).write.mode("append").parquet(box)


def test_streamed_upsert_is_idempotent_and_never_goes_back(spark):
    box, table, state = (scratch_path(spark, x) for x in ("box", "table", "state"))

    def run():
        source = stream.stream_inbox(spark, box, EVENT, fmt="parquet", files_per_trigger=1)
        stream.stream_upsert(source, table, state, "part", ["id", "part"], "ts", ["v"]).awaitTermination()
        return rows(spark.read.schema(EVENT).parquet(table).select("id", "v"))

    deliver(spark, box, [(1, 0, "b", T0 + timedelta(2)), (2, 0, "x", T0), (1, 0, "a", T0 + timedelta(1))])
    assert run() == [(1, "b"), (2, "x")]
    assert run() == [(1, "b"), (2, "x")], "nothing new has arrived"
    deliver(spark, box, [(1, 0, "late", T0), (2, 0, "y", T0 + timedelta(1)), (3, 1, "z", T0)])
    assert run() == [(1, "b"), (2, "y"), (3, "z")]
    again = spark.createDataFrame([(2, 0, "y", T0 + timedelta(1))], EVENT)
    stream.merge_batch(table, "part", ["id", "part"], "ts", ["v"])(again, 99)
    assert rows(spark.read.schema(EVENT).parquet(table).select("id", "v")) == [(1, "b"), (2, "y"), (3, "z")]


def test_default_start_is_a_constant(spark):
    assert spark.range(1).select(as_ts(inc.DEFAULT_START)).first()[0] == datetime(2000, 1, 1)


def test_product_load_audits(tables):
    from checks.q_datasets import product_load

    out = product_load(tables)
    touched = out["touched"].count()
    assert touched == out["products"].count() > 0
    assert out["duplicates"].count() == 0
    assert out["watermark"].first()["watermark_id"] is not None
