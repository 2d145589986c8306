from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from comptoir.operators import aggregates as agg
from comptoir.operators import quality as dq
from comptoir.plans import expenses as ex
from comptoir.plans import reports as rp
from comptoir.plans import stock
from tests.conftest import rows

DAY = date(2024, 3, 5)
METHODS = {"cash": "Cash", "card": "Card"}


@pytest.fixture
def till(spark):
    pay = spark.createDataFrame(
        [(1, 1, DAY, D(100)), (1, 2, DAY, D(50)), (2, 2, DAY, D(70)), (1, 9, DAY, D(5)), (1, 1, date(2024, 3, 7), D(8))],
        "config_id long, method_id long, payment_day date, amount decimal(16,4)",
    )
    shops = spark.createDataFrame([(1, "Shop - A"), (2, "shop_b")], "shop_id long, name string")
    methods = spark.createDataFrame([(1, "Cash"), (2, "Card")], "method_id long, name string")
    spent = spark.createDataFrame(
        [("ann", DAY, D(30)), ("ann", DAY, D(0)), ("bob", DAY, D(4)), ("cy", DAY, D(2)), ("ann", date(2024, 3, 6), D(9))],
        "employee_name string, expense_date date, total_amount decimal(16,4)",
    )
    staff = spark.createDataFrame(
        [("SHOPA", "ann", True, DAY, DAY), ("SHOPB", "bob", True, DAY, date(2024, 12, 31)), ("SHOPA", "cy", False, DAY, DAY)],
        "shop_key string, employee_name string, is_active boolean, valid_from date, valid_to date",
    )
    return pay, shops, methods, spent, staff


def test_daily_revenue(till):
    got = rp.daily_revenue(*till, DAY, pay_methods=METHODS, cash="cash").orderBy("numero").collect()
    assert [(r.numero, r.shop, r.total_sales, r.cash, r.card, r.expenses, r.to_deposit) for r in got] == [
        (1, "Shop - A", 155, 100, 50, 30, 70),
        (2, "shop_b", 70, 0, 70, 4, None),
    ]


def test_month_to_date_is_numbered_through(till):
    got = rp.daily_revenue_period(*till, from_day="2024-03-07", pay_methods=METHODS, cash="cash")
    assert [(r.numero, r.day.day, r.shop) for r in got.orderBy("numero").collect()] == [
        (1, 5, "Shop - A"), (2, 5, "shop_b"), (3, 7, "Shop - A")
    ]


def test_sections_have_every_day(spark, till):
    got = rp.daily_revenue_by_day(spark, *till, day="2024-03-07", pay_methods=METHODS, cash="cash")
    assert rows(got.groupBy("section").agg(F.count("shop"))) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 2), (6, 0), (7, 1)]


def test_last_days_leave_out_today(till):
    got = rp.daily_revenue_last(*till, as_of="2024-03-07", pay_methods=METHODS, cash="cash")
    assert {r.day for r in got.collect()} == {DAY}


def test_period():
    assert rp.period("2024-03-05") == (date(2024, 3, 1), DAY)
    assert rp.period("2024-03-05", "2024-03-06") == (DAY, date(2024, 3, 6))
    with pytest.raises(ValueError):
        rp.period("2024-03-05", "2024-03-04")


def test_age_boundaries(spark):
    ages = [29, 30, 89, 90, 179, 180, 359, 360, 361, None, -5]
    df = spark.createDataFrame([("l", a, D(1)) for a in ages], "loc string, age_days int, opening_qty decimal(16,4)")
    got = agg.stock_age(df, ["loc"]).first()
    assert [int(got[c]) for c in agg.AGE_BUCKETS] == [2, 2, 2, 2, 1]
    assert int(agg.stock_age(df, ["loc"], close_gap=True).first()["stock_gt_360"]) == 2


def test_location_with_only_unaged_stock_stays(spark):
    df = spark.createDataFrame([("l", None, D(3))], "loc string, age_days int, opening_qty decimal(16,4)")
    assert [int(x) for x in agg.stock_age(df, ["loc"]).first()[1:]] == [0] * 5


def test_openings_built_from_moves_reconcile(spark, tables):
    """Opening of a day = everything moved before it, so nothing may be left over."""
    first, last = "1997-03-01", "1997-03-20"
    moves = tables.movement.withColumn("barcode", F.lit("B1"))
    net = F.when(F.col("side") == "SRC", -F.col("qty")).otherwise(F.col("qty"))
    days = spark.sql("SELECT explode(sequence(DATE '1997-02-28', DATE '1997-03-20')) AS opening_date")
    openings = moves.join(days, F.col("movement_day") < F.col("opening_date")).groupBy("opening_date", "location_id").agg(
        F.sum(net).cast("decimal(16,4)").alias("opening_qty")
    )
    names = [r[0] for r in tables.location.select("name_norm").collect()]
    got = rp.stock_situation(openings, moves, tables.location, first, last, names)
    assert got.count() == 20 * len(names)
    assert got.filter("variance <> 0").count() == 0
    assert got.filter("net_movement <> 0").count() > 0


def test_negative_stock_is_kept_on_request(spark):
    quants = spark.createDataFrame(
        [(1, 1, 2.0, None), (1, 1, -3.0, None), (1, 2, 5.0, None), (2, 1, 1.0, None), (None, 1, 1.0, None), (1, 9, 1.0, None)],
        "product_id long, location_id long, quantity double, in_date timestamp_ntz",
    )
    loc = spark.createDataFrame([(1, "internal"), (2, "customer"), (9, "internal")], "location_id long, usage string")
    prod = spark.createDataFrame([(1, "Lace", True, 2.0, 3.0), (2, "Lace", False, 1.0, 1.0)],
                                 "product_id long, display_name string, sale_ok boolean, standard_price double, lst_price double")
    opening = lambda **k: stock.fct_stock_opening(quants, loc, prod, "2024-01-01", excluded_locations=[9], **k)
    assert rows(opening().select("opening_qty", "value_cost", "in_date")) == [(D("2.0000"), D("4.0000"), date(2024, 1, 1))]
    kept = opening(keep_negative=True)
    assert rows(kept.select("value_sale")) == [(D("-9.0000"),), (D("6.0000"),)]
    assert dq.negative_stock(kept, "opening_qty").count() == 1


def test_exceptions_need_current_products(spark):
    openings = spark.createDataFrame([(DAY, p, 1, D(-1), D(1), D(1)) for p in (1, 2)],
                                     "opening_date date, product_id int, location_id int, opening_qty decimal(16,4), unit_cost decimal(16,4), unit_sale_price decimal(16,4)")
    prod = spark.createDataFrame([(1, "B", "n", "c", True), (2, "B", "n", "c", False)],
                                 "product_id int, barcode string, name_norm string, category_norm string, is_current boolean")
    loc = spark.createDataFrame([(1, "L")], "location_id int, complete_name string")
    assert [r.status_qty for r in rp.stock_exceptions(openings, prod, loc, DAY).collect()] == ["STOCK NEGATIF"]


def test_expense_reload_counts_empty_days(spark):
    raw = spark.createDataFrame([(1, "2024-03-05", '[1,"ann"]', 3.0, "done", "2024-03-05 10:00:00", "false"),
                                 (2, "2024-03-07", "false", None, "draft", "2024-03-07 10:00:00", "false"),
                                 (3, "false", "false", 1.0, "draft", "2024-03-07 10:00:00", "false")],
                                "id long, date string, employee_id string, total_amount double, state string, write_date string, create_date string")
    target = ex.fct_expense(raw, "2024-01-01 00:00:00").limit(0)
    merged, per_day = ex.reload_expenses(target, raw, "2024-03-08 00:00:00", "2024-03-05", "2024-03-07", purge=True)
    assert rows(merged.select("expense_id", "employee_name", "total_amount")) == [(1, "ann", D("3.0000")), (2, None, D("0.0000"))]
    assert [n for _, n in rows(per_day)] == [1, 0, 1]


def test_report_status(spark):
    out = spark.createDataFrame([("A", date(2024, 1, 1)), ("A", DAY), ("B", date(2024, 1, 1))], "family string, report_day date")
    got = {r.family: r.status for r in dq.report_status(out, DAY, ["A", "B", "C"]).collect()}
    assert got == {"A": "FRESH", "B": "STALE", "C": "MISSING"}


def test_coverage(spark):
    df = spark.createDataFrame([(date(2024, 1, 31),), (date(2024, 3, 1),)], "d date")
    assert [r[0] for r in rows(dq.missing_months(df, "d", "2024-01-15", "2024-03-02"))] == [date(2024, 2, 1)]
    assert dq.missing_days(df, "d", "2024-01-30", "2024-02-01").count() == 2


def test_reports_come_in_their_order(tables):
    """Presentation order, with missing values last, as the reports list them."""
    moved = [(r.movement_day, r.side) for r in run_query("rp_04_stock_movement", tables)]
    assert moved == sorted(moved)
    odd = [(r.location is None, r.location, r.category is None, r.category or "") for r in run_query("rp_08_stock_exceptions", tables)]
    assert odd == sorted(odd)


def run_query(name, tables):
    from checks import QUERIES

    return QUERIES[name][0](tables).collect()
