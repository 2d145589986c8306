from __future__ import annotations

import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from comptoir import session
from comptoir.operators.sets import to_double_entry
from comptoir.plans import movements as mv
from comptoir.session import scratch_path
from comptoir.sources import files, scans, slices
from tests.conftest import plan, rows

RECORD = {
    "odoo_id": 5, "move_id": 1, "picking_id": None, "product_id": 2, "location_id": 3, "location_dest_id": 4, "qty": 1.5,
    "uom": "Units", "state": "done", "date_value": False, "write_date": "2024-01-02 03:04:05", "barcode": False,
    "unit_sale_price": 10.0, "unit_cost": 4,
    "raw": {"id": 5, "picking_id": [9, "WH/IN/9"], "reference": False, "movement_ref": "WH/IN/9"},
}


def plain_file(tmp_path, name, *records):
    path = tmp_path / name
    with gzip.open(path, "wt") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    return str(path)


def test_foreign_extract_file(spark, tmp_path):
    """A single gzipped JSON-lines file with a nested record and ``false`` for missing."""
    undated = {**RECORD, "odoo_id": 6, "write_date": False}
    path = plain_file(tmp_path, "stock_move_line_20240102.jsonl.gz", RECORD, undated, {**RECORD, "odoo_id": None})
    staged = mv.stg_move_line(files.read_move_lines(spark, path), "2024-01-03 00:00:00")
    row = staged.collect()
    assert len(row) == 1
    row = row[0]
    assert (row.part_day, row.movement_ref, row.barcode, row.dup_flag) == (date(2024, 1, 2), "WH/IN/9", None, 0)
    assert row.source_file == "stock_move_line_20240102.jsonl.gz"
    assert json.loads(row.payload)["raw"]["picking_id"] == [9, "WH/IN/9"]


def test_repeated_lines_are_flagged_once_seen(spark, tmp_path):
    path = plain_file(tmp_path, "a.jsonl.gz", RECORD, RECORD, {**RECORD, "qty": 2.0}, RECORD)
    staged = mv.stg_move_line(files.read_move_lines(spark, path), "2024-01-03 00:00:00")
    assert rows(staged.select("qty_done", "dup_flag").withColumn("qty_done", F.col("qty_done").cast("double"))) == [
        (1.5, 0), (1.5, 1), (1.5, 1), (2.0, 0)
    ]


def test_latest_of_plain_files_and_of_folders(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    plain_file(inbox, "stock_move_line_20240101.jsonl.gz", RECORD)
    newest = plain_file(inbox, "stock_move_line_20240201.jsonl.gz", RECORD)
    assert files.latest_file(spark, str(inbox)).endswith(newest)
    out = files.write_extract(files.read_move_lines(spark, newest), str(inbox), datetime(2024, 3, 1), datetime(2024, 2, 1))
    assert files.latest_file(spark, str(inbox)).endswith(out)


def test_empty_inbox(spark, tmp_path):
    assert files.latest_file(spark, str(tmp_path)) is None


def test_extract_round_trip_keeps_the_nested_record(spark, tmp_path):
    lines = files.read_move_lines(spark, plain_file(tmp_path, "x.jsonl.gz", RECORD)).drop("source_file")
    out = files.write_extract(lines, str(tmp_path / "out"), datetime(2024, 1, 3), datetime(2024, 1, 1))
    text = spark.read.text(out).first()[0]
    assert json.loads(text)["raw"]["picking_id"] == [9, "WH/IN/9"]
    manifest = spark.read.json(f"{tmp_path}/out/manifests/*").first()
    assert (manifest["rows"], manifest["filter_done"], manifest["data_file"]) == (1, True, "stock_move_line_20240103_000000")


def test_payload_nests_relations(spark):
    df = spark.createDataFrame([(1, '[2,"a \\"b\\""]', None), (2, "false", "x")], "id int, rel string, s string")
    got = [json.loads(r.payload) for r in scans.with_payload(df, relations=["rel"]).orderBy("id").collect()]
    assert got == [{"id": 1, "rel": [2, 'a "b"'], "s": None}, {"id": 2, "rel": False, "s": "x"}]


def test_month_table_prunes_and_replaces(spark):
    path = scratch_path(spark, "m")
    days = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 5)), (3, date(2024, 3, 5))], "k int, d date")
    files.write_partitioned(days, path, "d", "month")
    files.write_partitioned(spark.createDataFrame([(9, date(2024, 2, 6))], "k int, d date"), path, "d", "month")
    stored = files.read_day_range(spark, path, "d", date(2024, 1, 1), date(2024, 2, 28))
    assert rows(stored.select("k")) == [(1,), (9,)]
    assert "PartitionFilters: [isnotnull(part_month" in plan(stored)


def test_bad_grain(spark):
    with pytest.raises(ValueError):
        files.write_partitioned(spark.range(1).selectExpr("current_date() AS d"), "/nowhere", "d", "year")


def test_range_bounds():
    now = datetime(2024, 1, 2)
    assert slices.range_bounds("daily", now) == (datetime(2024, 1, 1), now)
    with pytest.raises(ValueError):
        slices.range_bounds("hist", now, from_=now)


def test_slice_boundaries(spark):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1, i)) for i in range(4)], "id long, t timestamp_ntz")
    ids = lambda d: [r[0] for r in rows(d.select("id"))]
    assert ids(slices.slice_since(df, "t", "id", "2024-01-01 01:00:00", 0)) == [1, 2, 3]
    assert ids(slices.slice_since(df, "t", "id", "2024-01-01 01:00:00", 1)) == [2, 3]
    assert ids(slices.slice_since(df, "t", "id", "2024-01-01 01:00:00", 1, max_rows=1)) == [2]
    assert ids(slices.slice_last(df, "t", "2024-01-01 03:00:00", hours=2)) == [2, 3]
    assert ids(slices.slice_last(df, "t", "2024-01-01 03:00:00", hours=2, inclusive=True)) == [1, 2, 3]
    assert ids(slices.slice_range(df, "t", "2024-01-01 01:00:00", "2024-01-01 03:00:00")) == [1, 2]


def test_missing_columns_are_logged(spark, caplog):
    assert scans.keep_existing(spark.range(1), ["id", "gone"]).columns == ["id"]
    assert "gone" in caplog.text


def test_double_entry_quantities_cancel(tables):
    entries = mv.movement_entries(tables.staged, tables.location, "2024-01-01 00:00:00", done_only=False)
    net = F.sum(F.when(F.col("side") == "SRC", -F.col("qty")).otherwise(F.col("qty")))
    assert entries.agg(net).first()[0] == 0
    assert entries.count() == 2 * tables.staged.count()


def test_double_entry_is_narrow(spark):
    df = spark.range(3).selectExpr("id", "id AS a", "id + 1 AS b")
    both = to_double_entry(df, {"a": F.col("a")}, {"a": F.col("b")})
    assert "Exchange" not in plan(both) and both.count() == 6


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_the_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(named)
    assert session.cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file://").startswith(named)
