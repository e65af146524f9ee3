"""Marts that follow the changes against marts rebuilt from the snapshot."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import deltas, marts
from tidemark.schemas import ENTITIES
from tidemark.sinks.keyed import KeyedTable

ORDERS = ENTITIES["orders"].payload
ITEMS = ENTITIES["order_items"].payload
STATUSES = ["PLACED", "CANCELLED", "DELIVERED", None]


def same(left, right):
    names = sorted(left.columns)
    assert names == sorted(right.columns)
    rows = [sorted(map(repr, df.select(*names).collect())) for df in (left, right)]
    assert rows[0] == rows[1]


def customers(spark):
    rows = [(i, "f", "l", "e", "c", "s") for i in range(6)]
    return spark.createDataFrame(rows, "customer_id long, first_name string, last_name string, email string, city string, state string")


def some_orders(dice, count):
    for _ in range(count):
        amount = dice.choice([None, 0.1, 0.2, 19.99, 1e9 + 0.01])
        day = dice.choice([None, "1998-01-02", "1998-01-03T10:00:00", "2001-05-06", "no date"])
        yield (dice.randrange(30), dice.choice([None, *range(5)]), dice.choice(STATUSES), amount, day, None)


def timed(orders):
    return orders.withColumn("order_date", F.col("order_date").try_cast("timestamp"))


def test_orders_change_and_vanish(spark, tmp_path):
    dice, gold = random.Random(2), str(tmp_path / "gold")
    table = KeyedTable(spark, str(tmp_path / "orders"), "order_id")
    replaced = lambda old, new: new
    for run in range(5):
        rows = spark.createDataFrame(list(some_orders(dice, 25)), ORDERS)
        merged = table.merge(rows, replaced)
        for _ in range(1 + run % 2):  # repeated runs replace themselves
            deltas.advance_marts(spark, gold, f"r{run}", {"orders": merged.changes})
        if run == 2:
            deltas.fold(spark, gold, "customer_lifetime_value")
        now = table.read()
        same(deltas.current_mart(spark, gold, "daily_sales", {}), marts.daily_sales_mart(now))
        mart = deltas.current_mart(spark, gold, "customer_lifetime_value", {"customers": customers(spark)})
        same(mart, marts.customer_lifetime_value_mart(customers(spark), timed(now)))
    # A run that was folded is not added a second time.
    assert not deltas.add_run(deltas.signed_rows(merged.changes, ENTITIES["orders"]), gold, "customer_lifetime_value", "r1")
    deltas.fold(spark, gold, "customer_lifetime_value")
    again = deltas.current_mart(spark, gold, "customer_lifetime_value", {"customers": customers(spark)})
    same(again, mart)
    built = deltas.write_marts  # all four need their sums
    with pytest.raises(Exception):
        built(spark, gold, {"customers": customers(spark)})


def test_a_delete_gives_back_the_date_before(spark, tmp_path):
    gold, entity = str(tmp_path / "gold"), ENTITIES["orders"]
    row = "struct<order_id:bigint,customer_id:bigint,order_status:string,total_amount:double,order_date:string,operation:string>"
    first, last = (1, 7, "PLACED", 5.0, "1998-01-01", "c"), (2, 7, "PLACED", 6.0, "1999-01-01", "c")
    steps = [[(None, first), (None, last)], [(first, (*first[:5], "d"))], [(last, (2, 7, "CANCELLED", 6.0, "1999-01-01", "u"))]]
    found = []
    for number, step in enumerate(steps):
        changes = spark.createDataFrame(step, f"old {row}, new {row}")
        deltas.add_run(deltas.signed_rows(changes, entity), gold, "customer_lifetime_value", str(number))
        rows = deltas._spending(deltas.mart_sums(spark, gold, "customer_lifetime_value")).collect()
        found.append([(r.lifetime_orders, r.lifetime_value, str(r.first_order_date)[:10]) for r in rows])
    assert found == [[(2, 11.0, "1998-01-01")], [(1, 6.0, "1999-01-01")], []]


def test_amounts_that_cannot_be_taken_off_show(spark, tmp_path):
    gold, entity = str(tmp_path / "gold"), ENTITIES["order_items"]
    rows = [(1, 1, 1, 2, float("nan")), (2, 1, 1, 1, 3.0), (3, 1, 2, None, 5.0), (4, 1, 3, 3, 1.005)]
    items = spark.createDataFrame(rows, ITEMS)
    deltas.add_run(deltas.all_rows(items), gold, "product_performance", "all")
    shown = {r.product_id: r for r in deltas._product_sales(deltas.mart_sums(spark, gold, "product_performance")).collect()}
    assert shown[1].gross_revenue != shown[1].gross_revenue and shown[1].total_units_sold == 3
    assert shown[2].gross_revenue is None and shown[2].total_units_sold is None
    bad = spark.createDataFrame([(rows[0], None)], f"old struct<{ITEMS.simpleString()[7:-1]}>, new struct<{ITEMS.simpleString()[7:-1]}>")
    deltas.add_run(deltas.signed_rows(bad, entity), gold, "product_performance", "less")
    same(
        deltas._product_sales(deltas.mart_sums(spark, gold, "product_performance")),
        marts.sales_by_product(spark.createDataFrame(rows[1:], ITEMS)),
    )


def test_a_run_reads_its_changes_only(spark, tmp_path):
    gold = str(tmp_path / "gold")
    table = KeyedTable(spark, str(tmp_path / "orders"), "order_id")
    merged = table.insert_absent(spark.createDataFrame(list(some_orders(random.Random(1), 25)), ORDERS))
    rows = deltas.signed_rows(merged.changes, ENTITIES["orders"])
    read = deltas.partial_sums(rows, "daily_sales").inputFiles()
    assert read and all("/_changes/" in name for name in read)
