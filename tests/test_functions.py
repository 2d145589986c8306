from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from comptoir.functions import measures as m
from comptoir.functions import names as n
from comptoir.functions import records as r


def apply(spark, fn, values, schema="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {schema}")
    return [row[1] for row in df.select("i", fn(F.col("c"))).orderBy("i").collect()]


def test_many2one(spark):
    values = ['[7,"A, b"]', "[8]", "9", "false", None, "", '["x","y"]', "[]", '[10, "sp ace"]']
    assert apply(spark, r.m2o_id, values) == [7, 8, 9, None, None, None, None, None, 10]
    assert apply(spark, r.m2o_name, values) == ["A, b", None, None, None, None, None, "y", None, "sp ace"]


def test_clean_false(spark):
    assert apply(spark, r.clean_false, ["false", "False", "", None, "x"]) == [None, "False", "", None, "x"]


def test_parse_dt(spark):
    values = ["2024-02-29 23:59:59", " 2024-01-02 03:04:05 ", "2023-02-29 00:00:00", "2024-01-02", "false", "", None, "bad"]
    assert apply(spark, r.parse_dt, values) == [
        datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 1, 2, 3, 4, 5), None, None, None, None, None, None
    ]


def test_parse_dt_keeps_times_a_zone_would_skip(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert apply(spark, r.parse_dt, ["2024-03-31 02:30:00"]) == [datetime(2024, 3, 31, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_safe_double(spark):
    values = ["1.5", " -2 ", "1e3", "true", "false", "", None, "1d", "NaN", "x"]
    assert apply(spark, r.safe_double, values) == [1.5, -2.0, 1000.0] + [None] * 7


def test_movement_ref(spark):
    df = spark.createDataFrame(
        [('[1,"P"]', "R", "D"), ("false", "R", "D"), ("false", "false", "D"), (None, None, "false")],
        "p string, r string, d string",
    )
    assert [x[0] for x in df.select(r.movement_ref("p", "r", "d")).collect()] == ["P", "R", "D", None]


def test_payload_ref_only_from_arrays(spark):
    df = spark.createDataFrame(
        [("A", '{"raw":{"picking_id":[1,"B"]}}'), (None, '{"raw":{"picking_id":[1,"B"]}}'),
         (None, '{"raw":{"picking_id":false}}'), (None, None)],
        "ref string, payload string",
    )
    got = [x[0] for x in df.select(r.movement_ref_or_payload("ref", "payload")).collect()]
    assert got == ["A", "B", None, None]


def test_code_prefix(spark):
    assert apply(spark, n.has_code_prefix, ["A-b", " -b", "-b", "ab", "\t-b", None, "A -"]) == [
        True, False, False, False, False, False, True
    ]


def test_norm_product(spark):
    values = ["[tag] AB12 - Lace  front - 2", "plain  name", "[a] [b] X-y", None, "-", "[]x"]
    assert apply(spark, n.norm_product, values) == ["LACE FRONT - 2", "PLAIN NAME", "Y", "", "", "[]X"]


def test_canon_uom(spark):
    values = ["Unit", " PCS ", "unité", "Pièce", None, "", " Box "]
    assert apply(spark, n.canon_uom, values) == ["Units"] * 6 + ["Box"]


def test_category_takes_first_keyword(spark):
    values = ["All / Lace / Perruque", "all / plante", "closure lace", "other", None]
    assert apply(spark, n.pos_category, values) == ["VENTE / PERRUQUE", "VENTE / PLANTE", "VENTE / LACE", None, None]


def test_site(spark):
    values = ["Depot/Central/x", "boutique b24", "x boutique", "", None]
    assert apply(spark, n.norm_site, values) == ["DEPOT_CENTRAL", "BOUTIQUE", "OTHER", "OTHER", "OTHER"]


def test_tracked_product(spark):
    names = ["Lace wig", "Coiffure lace", "[VIEUX] lace", "  coiffure lace", "soap", None]
    trimmed = apply(spark, lambda c: n.is_tracked_product(c, F.lit(True)), names)
    assert trimmed == [True, False, False, False, False, False]
    loose = apply(spark, lambda c: n.is_tracked_product(c, F.lit(True), strip=False), names)
    assert loose == [True, False, False, True, False, False]
    assert apply(spark, lambda c: n.is_tracked_product(c, F.lit(False)), ["Lace"]) == [False]


def test_shop_key(spark):
    assert apply(spark, n.shop_key, [" b-24 _x ", "B24X", None]) == ["B24X", "B24X", None]


def test_valid_barcode(spark):
    assert apply(spark, n.valid_barcode, ["A1", "z", "1A", "", "false", None]) == [True, True, False, False, False, False]


def test_location_key(spark):
    values = ["Depot/Central New/Stock", " Boutique / B24 /Stock "]
    assert apply(spark, n.location_key, values) == ["DEPOT | CENTRAL NEW | STOCK", "BOUTIQUE | B24 | STOCK"]


def test_date_key(spark):
    assert apply(spark, m.date_key, [date(2024, 1, 9), None], "date") == [20240109, None]


def test_movement_day_modes(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2), datetime(2024, 1, 1)), (None, datetime(2024, 1, 1)), (datetime(2024, 1, 2), None), (None, None)],
        "w timestamp_ntz, b timestamp_ntz",
    )
    got = df.select(m.movement_day("w", "b"), m.movement_day("w", "b", "date")).collect()
    assert [tuple(x) for x in got] == [
        (date(2024, 1, 2), date(2024, 1, 1)), (date(2024, 1, 1),) * 2, (date(2024, 1, 2),) * 2, (None, None)
    ]


def test_dup_key_text(spark):
    """The digest is that of the plain text form of the parts."""
    df = spark.createDataFrame([(5, datetime(2024, 1, 2, 3, 4, 5), 10_000_000.0), (6, None, None)], "i long, t timestamp_ntz, q double")
    got = [x[0] for x in df.select(m.dup_key("i", "t", "q")).collect()]
    want = ["5|2024-01-02 03:04:05|10000000.0", "6|None|None"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_plain_number(spark):
    assert apply(spark, m.plain_number, [1.0, 1.25, 0.0001, 1e7, 100.0, -3.5, None], "double") == [
        "1.0", "1.25", "0.0001", "10000000.0", "100.0", "-3.5", None
    ]


def test_signed_quantities(spark):
    df = spark.createDataFrame(
        [("SRC", Decimal(-3), True), ("DST", Decimal(-3), True), ("SRC", Decimal(3), False), ("OTHER", Decimal(3), True)],
        "s string, q decimal(16,4), i boolean",
    )
    own = [x[0] for x in df.select(m.signed_qty("s", "q", "i")).collect()]
    everywhere = [x[0] for x in df.select(m.movement_qty("s", "q")).collect()]
    assert own == [-3, 3, 0, 3]
    assert everywhere == [-3, 3, -3, 0]


def test_value_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("-0.5"), Decimal("0.0001")), (Decimal(2), None)], "q decimal(16,4), p decimal(16,4)")
    assert [x[0] for x in df.select(m.value("q", "p")).collect()] == [Decimal("0.0001"), Decimal(0)]


def test_status(spark):
    assert apply(spark, m.qty_status, [-1, 0, 1, 2, None], "int") == ["STOCK NEGATIF", "OK", "OK", "STOCK > 1", "OK"]
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (None, 0)], "p int, c int")
    assert [x[0] for x in df.select(m.fin_status("p", "c")).collect()] == [
        "PRIX & COUT NULS", "COUT MANQUANT", "PRIX DE VENTE MANQUANT", "OK", "OK"
    ]


def test_overflow_split(spark):
    df = spark.createDataFrame([(1, 999999999999.0), (2, 1e12), (3, -1e13), (4, None), (5, 999999999999.99996)], "i int, a double")
    kept, rejected = m.split_overflow(df, "a")
    assert [x.i for x in kept.orderBy("i").collect()] == [1, 4]
    assert [x.i for x in rejected.orderBy("i").collect()] == [2, 3, 5]


def test_surrogate_key_tells_missing_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("a", "")], "x string, y string")
    assert df.select(m.surrogate_key("x", "y").alias("k")).distinct().count() == 4
