import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.rules import validate
from tidemark.operators.deadletter import dead_letters
from tidemark.plans import marts, reports
from tidemark.schemas import ENTITIES
from tidemark.sinks import tables as sinks
from tidemark.sources import tables as inputs

ORDER = "order_id long, customer_id long, order_status string, total_amount double, order_date string"


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, "DELIVERED", 1000.0, "2026-10-01"),
            (2, 20, "SHIPPED", 2500.0, "2026-10-01"),
            (3, 10, "CANCELLED", 500.0, "2026-10-01"),
            (4, 10, "DELIVERED", 1500.0, "2026-10-02"),
            (5, 10, None, 99.0, "2026-10-02"),
        ],
        ORDER,
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [(10, "Aarav", "Rao", "a@x.in", "Pune", "MH"), (20, "Diya", "Sen", "d@x.in", "Agra", "UP"),
         (30, "Isha", None, "i@x.in", "Agra", "UP")],
        "customer_id long, first_name string, last_name string, email string, city string, state string",
    )


@pytest.fixture
def catalog(spark):
    products = spark.createDataFrame(
        [(1, "A", "Home", 5.0, 1), (2, "B", "Home", 6.0, 1), (3, "C", "Toys", 7.0, 1), (4, "D", None, 8.0, 1),
         (5, "E", None, 9.0, 1)],
        "product_id long, product_name string, category string, price double, stock_quantity int",
    )
    items = spark.createDataFrame(
        [(1, 1, 1, 2, 5.0), (2, 1, 1, 1, 5.0), (3, 2, 2, 5, 1.0), (4, 2, 4, 1, 8.0), (5, 2, 99, 1, 1.0)],
        "order_item_id long, order_id long, product_id long, quantity int, unit_price double",
    )
    return products, items


def test_daily_sales(orders):
    rows = reports.daily_sales(orders).collect()
    assert [(str(r.order_dt), r.total_orders, r.daily_revenue, r.cumulative_monthly_revenue) for r in rows] == [
        ("2026-10-02", 1, 1500.0, 5000.0),
        ("2026-10-01", 2, 3500.0, 3500.0),
    ]
    assert reports.top_revenue_days(orders, 1).first().daily_revenue == 3500.0


def test_daily_sales_with_unreadable_date(spark, orders):
    bad = spark.createDataFrame([(9, 1, "PLACED", 1.0, "soon")], ORDER)
    rows = reports.daily_sales(orders.union(bad)).collect()
    assert [str(r.order_dt) for r in rows] == ["2026-10-02", "2026-10-01", "None"]


def test_lifetime_value(customers, orders):
    mart = {r.customer_id: r for r in marts.customer_lifetime_value_mart(customers, orders).collect()}
    assert (mart[10].lifetime_orders, mart[10].lifetime_value, mart[10].average_basket_size) == (2, 2500.0, 1250.0)
    assert (str(mart[10].first_order_date), str(mart[10].latest_order_date)) == ("2026-10-01", "2026-10-02")
    assert mart[30].lifetime_orders is None and mart[30].lifetime_value is None
    report = reports.customer_lifetime_value(customers, orders).collect()
    assert [(r.customer_id, r.total_orders, r.lifetime_value, r.clv_rank) for r in report] == [
        (10, 2, 2500.0, 1), (20, 1, 2500.0, 1), (30, 0, 0.0, 2),
    ]
    assert report[2].customer_name is None
    assert [r.customer_id for r in reports.best_customers(customers, orders).collect()] == [10, 20]


def test_full_ranking(spark):
    rng = random.Random(3)
    values = [rng.choice([0.0, None, rng.randrange(500) / 4]) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "customer_id long, lifetime_value double")
    place = {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None}, reverse=True))}
    found = marts.ranked_customers(df).collect()
    assert len(found) == 3000
    assert all(r.clv_rank == place.get(r.lifetime_value) for r in found)


def test_product_performance(catalog):
    products, items = catalog
    found = {r.product_id: r for r in reports.product_performance(products, items).collect()}
    assert {i: (r.total_units_sold, r.gross_revenue, r.category_revenue_percentage) for i, r in found.items()} == {
        1: (3, 15.0, 75.0), 2: (5, 5.0, 25.0), 3: (0, 0.0, None), 4: (1, 8.0, 100.0), 5: (0, 0.0, 0.0),
    }
    mart = {r.product_id: r for r in marts.product_performance_mart(products, items).collect()}
    assert mart[3].total_units_sold is None and mart[3].gross_revenue is None
    rollup = {r.category: (r.catalog_products, r.units_sold, r.gross_revenue, r.revenue_share_pct)
              for r in reports.category_rollup(products, items).collect()}
    assert rollup == {"Home": (2, 8, 20.0, 71.43), "Toys": (1, 0, 0.0, 0.0), None: (2, 1, 8.0, 28.57)}
    assert [r.product_id for r in reports.top_products(products, items, 2).collect()] == [1, 4]


def test_payments(spark):
    payments = spark.createDataFrame(
        [(1, "UPI", "SUCCESS", 10.0), (2, "UPI", "SUCCESS", 20.0), (3, "UPI", "FAILED", 5.0),
         (4, "CREDIT_CARD", "SUCCESS", 1.0), (5, None, "PENDING", None)],
        "payment_id long, payment_method string, payment_status string, payment_amount double",
    )
    found = {r.payment_method: r for r in reports.payment_summary(payments).collect()}
    assert (found["UPI"].total_transactions, found["UPI"].failed_transactions, found["UPI"].success_rate_pct) == (3, 1, 66.67)
    assert found["UPI"].avg_transaction_value == 11.67 and found[None].total_processed_volume is None
    rates = marts.with_success_rate(marts.payment_summary_mart(payments)).collect()
    assert {(r.payment_method, r.payment_status): r.success_rate_pct for r in rates} == {
        ("UPI", "SUCCESS"): 66.67, ("UPI", "FAILED"): 66.67, ("CREDIT_CARD", "SUCCESS"): 100.0,
        (None, "PENDING"): 0.0,
    }


def test_scorecard(spark, customers, orders, catalog):
    payments = spark.createDataFrame([(1, "SUCCESS"), (2, "FAILED")], "payment_id long, payment_status string")
    found = {r.metric: (r.value, r.detail) for r in reports.scorecard(orders, payments, *catalog).collect()}
    assert found == {
        "gross_revenue": (5000.0, None), "valid_orders": (3.0, None), "avg_basket_size": (1666.67, None),
        "active_customers": (2.0, None), "payment_success_pct": (50.0, None),
        "top_category_revenue": (20.0, "Home"),
    }


def test_empty_tables(spark, customers, orders, catalog):
    none = orders.limit(0)
    assert reports.daily_sales(none).count() == 0
    assert reports.customer_lifetime_value(customers, none).count() == 3
    products, items = catalog
    assert reports.product_performance(products, items.limit(0)).count() == 5


def test_city_revenue_of_many_orders(spark):
    dim = spark.range(1, 500).selectExpr("id AS customer_id", "concat('City_', id % 20) AS city")
    fact = spark.range(1, 10_001).selectExpr(
        "id AS order_id", "id % 499 + 1 AS customer_id", "cast((id * 1.5) % 5000 AS double) AS amount"
    )
    found = {r.city: r.revenue for r in reports.city_revenue(fact, dim, "amount").collect()}
    expected = {}
    for i in range(1, 10_001):
        city = f"City_{(1 + i % 499) % 20}"
        expected[city] = expected.get(city, 0.0) + (i * 1.5) % 5000
    assert found == expected


def test_poison_set_gives_nine_incident_groups(spark):
    orders = [(9000 + i, 10 + i, "PLACED", -250.0 * (i + 1), "2026-10-08") for i in range(5)]
    orders += [(9100 + i, 20 + i, "CORRUPTED_STATUS", 1500.0, "2026-10-08") for i in range(4)]
    customers = [(9200 + i, "B", "T", "not-an-email-format-missing-at-domain", "c", "s") for i in range(4)]
    customers += [(None, "N", "T", "nulluser@example.com", None, None)] * 3
    payments = [(9300 + i, 1000 + i, "UPI", "SUCCESS", -500.0) for i in range(4)]
    frames = {
        "orders": spark.createDataFrame(orders, ORDER),
        "customers": spark.createDataFrame(
            customers, "customer_id long, first_name string, last_name string, email string, city string, state string"
        ),
        "payments": spark.createDataFrame(
            payments, "payment_id long, order_id long, payment_method string, payment_status string, payment_amount double"
        ),
    }
    errors = None
    for table, df in frames.items():
        part = dead_letters(validate(df, table), ENTITIES[table], "run")
        errors = part if errors is None else errors.unionByName(part)
    found = reports.operations_audit(errors).collect()
    assert sum(r.incident_count for r in found) == 20 and len(found) == 9
    assert {r.validation_reason: r.incident_count for r in found if r.source_table == "payments"} == {
        "payment_amount must be >= 0, found: -500.0": 4
    }


def test_gold_job_and_views(spark, tmp_path, customers, orders, catalog):
    base = str(tmp_path)
    products, items = catalog
    payments = spark.createDataFrame(
        [(1, 1, "UPI", "SUCCESS", 10.0, "2026-10-01")],
        "payment_id long, order_id long, payment_method string, payment_status string, payment_amount double, payment_date string",
    )
    silver = {"customers": customers, "products": products, "orders": orders, "order_items": items, "payments": payments}
    for name, df in silver.items():
        assert sinks.write_table(df, f"{base}/silver/{name}", ENTITIES[name].partition_by) == df.count()
    built = marts.run_transformations(spark, f"{base}/silver", f"{base}/gold")
    assert {n: d.count() for n, d in built.items()} == {
        "daily_sales": 3, "customer_lifetime_value": 3, "product_performance": 5, "payment_summary": 1,
    }
    assert all("calculated_at" in d.columns for d in built.values())
    assert reports.run_report(spark, "daily_sales", base).count() == 2
    assert reports.run_report(spark, "operations_audit").count() == 0  # no errors yet: typed, empty
    sql = "SELECT order_status, count(*) AS n FROM orders_source GROUP BY order_status"
    assert {r.order_status: r.n for r in spark.sql(sql).collect()}["DELIVERED"] == 2


def test_end_to_end_split(spark, tmp_path):
    df = spark.createDataFrame(
        [(901, 1, "PLACED", 1200.0), (902, None, "PLACED", 800.0), (903, 2, "DELIVERED", -50.0), (904, 3, "SHIPPED", 3400.0)],
        "order_id long, customer_id long, order_status string, total_amount double",
    )
    judged = validate(df, "orders")
    silver = judged.filter("validation_status = 'VALID'").drop("validation_status", "validation_reason")
    sinks.write_table(silver, f"{tmp_path}/silver/orders")
    sinks.append_incidents(dead_letters(judged, ENTITIES["orders"], "run"), str(tmp_path))
    row = spark.read.parquet(f"{tmp_path}/silver/orders").agg(F.count("*"), F.sum("total_amount")).first()
    assert tuple(row) == (2, 4600.0)
    errors = inputs.read_errors(spark, str(tmp_path))
    assert {r.record_id for r in errors.collect()} == {"902", "903"}
