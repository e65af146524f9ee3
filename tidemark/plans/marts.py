"""The four gold marts. Each ``*_mart`` function is pure; each ``build_*`` function stamps
and stores it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.money import avg_money, percent2, total_money
from tidemark.functions.temporal import to_day
from tidemark.operators.ranking import dense_rank_all
from tidemark.schemas import CANCELLED
from tidemark.session import staged
from tidemark.sinks.tables import write_mart
from tidemark.sources.tables import load_silver


def kept_orders(orders: DataFrame) -> DataFrame:
    """Orders that count as sales. A null status is no sale."""
    return orders.filter(F.col("order_status") != CANCELLED)


def spending_by_customer(orders: DataFrame) -> DataFrame:
    """One row per customer with sales. Reduced before any join, so the join sees each
    customer once however many orders there are."""
    return (
        kept_orders(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("lifetime_orders"),
            total_money("total_amount").alias("lifetime_value"),
            avg_money("total_amount").alias("average_basket_size"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("latest_order_date"),
        )
    )


ITEM_VALUE = "quantity * unit_price"


def sales_by_product(order_items: DataFrame) -> DataFrame:
    """One row per sold product: units and revenue."""
    return order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        total_money(ITEM_VALUE).alias("gross_revenue"),
    )


def daily_sales_mart(orders: DataFrame) -> DataFrame:
    """Orders, revenue and mean value per day and status."""
    return (
        kept_orders(orders)
        .groupBy(to_day("order_date").alias("order_date_dt"), "order_status")
        .agg(
            F.count("order_id").alias("total_orders"),
            total_money("total_amount").alias("total_revenue"),
            avg_money("total_amount").alias("avg_order_value"),
        )
    )


def customer_lifetime_value_mart(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with lifetime figures; nulls for customers without sales."""
    return customers.join(spending_by_customer(orders), "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "city",
        "state",
        "lifetime_orders",
        "lifetime_value",
        "average_basket_size",
        "first_order_date",
        "latest_order_date",
    )


def ranked_customers(lifetime_value: DataFrame) -> DataFrame:
    """The customer mart with ``clv_rank`` for every customer that has a value. The cut
    points and the ranks both read the mart, so it is computed once and written."""
    return dense_rank_all(staged(lifetime_value, "clv"), "lifetime_value", "clv_rank")


def product_performance_mart(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every product with units and revenue; nulls for products without sales."""
    return products.join(sales_by_product(order_items), "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "price",
        "stock_quantity",
        "total_units_sold",
        "gross_revenue",
    )


def payment_summary_mart(payments: DataFrame) -> DataFrame:
    """Transactions and amounts per method and status."""
    return payments.groupBy("payment_method", "payment_status").agg(
        F.count("payment_id").alias("transaction_count"),
        total_money("payment_amount").alias("total_amount"),
        avg_money("payment_amount").alias("avg_payment_amount"),
    )


def with_success_rate(payment_mart: DataFrame) -> DataFrame:
    """The payment mart with the success rate of its method."""
    method = Window.partitionBy("payment_method")  # a few statuses each
    won = F.when(F.col("payment_status") == "SUCCESS", F.col("transaction_count")).otherwise(0)
    return (
        payment_mart.withColumn("_won", F.sum(won).over(method))
        .withColumn("_all", F.sum("transaction_count").over(method))
        .withColumn("success_rate_pct", percent2("_won", "_all"))
        .drop("_won", "_all")
    )


def _store(mart: DataFrame, gold_base: str, name: str) -> DataFrame:
    write_mart(mart.withColumn("calculated_at", F.current_timestamp()), gold_base, name)
    return mart.sparkSession.read.parquet(f"{gold_base.rstrip('/')}/{name}")


def build_daily_sales(orders: DataFrame, gold_base: str) -> DataFrame:
    return _store(daily_sales_mart(orders), gold_base, "daily_sales")


def build_customer_lifetime_value(
    customers: DataFrame, orders: DataFrame, gold_base: str
) -> DataFrame:
    mart = customer_lifetime_value_mart(customers, orders)
    return _store(mart, gold_base, "customer_lifetime_value")


def build_product_performance(
    products: DataFrame, order_items: DataFrame, gold_base: str
) -> DataFrame:
    return _store(product_performance_mart(products, order_items), gold_base, "product_performance")


def build_payment_summary(payments: DataFrame, gold_base: str) -> DataFrame:
    return _store(payment_summary_mart(payments), gold_base, "payment_summary")


def run_transformations(spark: SparkSession, silver_base: str, gold_base: str) -> dict[str, DataFrame]:
    """Rebuild all marts from the silver snapshots."""
    silver = load_silver(spark, silver_base)
    return {
        "daily_sales": build_daily_sales(silver["orders"], gold_base),
        "customer_lifetime_value": build_customer_lifetime_value(
            silver["customers"], silver["orders"], gold_base
        ),
        "product_performance": build_product_performance(
            silver["products"], silver["order_items"], gold_base
        ),
        "payment_summary": build_payment_summary(silver["payments"], gold_base),
    }
