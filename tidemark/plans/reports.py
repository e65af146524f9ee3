"""Analytical reports over the silver tables and the dead-letter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.money import avg_money, percent2, round2, sum_money, total_money
from tidemark.functions.temporal import month_key, to_day
from tidemark.operators.ranking import top_with_dense_rank
from tidemark.plans.marts import (
    kept_orders,
    product_performance_mart,
    sales_by_product,
    spending_by_customer,
)
from tidemark.sources.tables import register_views


def _sales_by_day(orders: DataFrame) -> DataFrame:
    """Days with running revenue of their month. The window sees at most 31 aggregated
    rows per month."""
    days = (
        kept_orders(orders)
        .groupBy(to_day("order_date").alias("order_dt"))
        .agg(
            F.count("order_id").alias("total_orders"),
            sum_money("total_amount").alias("_revenue"),
            avg_money("total_amount").alias("avg_order_value"),
        )
        .withColumn("order_month", month_key(F.col("order_dt")))
    )
    month_so_far = (
        Window.partitionBy("order_month")
        .orderBy("order_dt")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return days.withColumn("_running", F.sum("_revenue").over(month_so_far)).select(
        "order_month",
        "order_dt",
        "total_orders",
        round2("_revenue").alias("daily_revenue"),
        "avg_order_value",
        round2("_running").alias("cumulative_monthly_revenue"),
    )


def daily_sales(orders: DataFrame) -> DataFrame:
    """Revenue per day with the running total of its month, newest day first."""
    return _sales_by_day(orders).orderBy(F.desc("order_dt"))


def top_revenue_days(orders: DataFrame, k: int = 5) -> DataFrame:
    """The days with the greatest revenue."""
    return _sales_by_day(orders).orderBy(F.desc("daily_revenue"), F.desc("order_dt")).limit(k)


def _customer_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")


def customer_lifetime_value(customers: DataFrame, orders: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` customers who spent most, customers without sales counting as zero."""
    spending = spending_by_customer(orders)
    everyone = customers.join(spending, "customer_id", "left").select(
        "customer_id",
        _customer_name(),
        "email",
        "city",
        "state",
        F.coalesce("lifetime_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("lifetime_value", F.lit(0.0)).alias("lifetime_value"),
        F.coalesce("average_basket_size", F.lit(0.0)).alias("avg_order_value"),
    )
    return top_with_dense_rank(everyone, "lifetime_value", "customer_id", k, "clv_rank")


def best_customers(customers: DataFrame, orders: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` customers who spent most, buyers only."""
    buyers = customers.join(spending_by_customer(orders), "customer_id").select(
        "customer_id",
        _customer_name(),
        "city",
        "state",
        F.col("lifetime_orders").alias("total_orders"),
        "lifetime_value",
        F.col("average_basket_size").alias("avg_order_value"),
    )
    return top_with_dense_rank(buyers, "lifetime_value", "customer_id", k, "clv_rank")


def product_performance(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """Products with units, revenue and share of their category's revenue.

    Category totals are an aggregate joined back, not a window over the category, which
    would sort all products of a category in one task. Both sides of that join use the
    same per-product aggregate: the totals look at ``total_units_sold`` too, so that the
    two plans stay equal and the line items are scanned and shuffled once.
    """
    sales = sales_by_product(order_items)
    sold = "CASE WHEN total_units_sold IS NOT NULL THEN gross_revenue END"
    totals = (
        products.select("product_id", "category")
        .join(sales, "product_id")
        .groupBy("category")
        .agg(sum_money(sold).alias("_category_revenue"))
    )
    # Products without a category form a group of their own, as in a window partition.
    listed = products.join(sales, "product_id", "left").alias("p")
    same = F.col("p.category").eqNullSafe(F.col("t.category"))
    revenue = "coalesce(p.gross_revenue, 0.0D)"
    return (
        listed.join(totals.alias("t"), same, "left")
        .select(
            F.col("p.category").alias("category"),
            "p.product_id",
            "p.product_name",
            "p.price",
            "p.stock_quantity",
            F.coalesce("p.total_units_sold", F.lit(0)).alias("total_units_sold"),
            F.expr(revenue).alias("gross_revenue"),
            percent2(revenue, "t._category_revenue").alias("category_revenue_percentage"),
        )
        .orderBy(F.desc("gross_revenue"), "product_id")
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Transactions, success rate and volume per payment method."""
    success, total = "count_if(payment_status = 'SUCCESS')", "count(payment_id)"
    return (
        payments.groupBy("payment_method")
        .agg(
            F.expr(total).alias("total_transactions"),
            F.expr(success).alias("successful_transactions"),
            F.count_if(F.col("payment_status") == "FAILED").alias("failed_transactions"),
            percent2(success, total).alias("success_rate_pct"),
            total_money("payment_amount").alias("total_processed_volume"),
            avg_money("payment_amount").alias("avg_transaction_value"),
        )
        .orderBy(F.desc("total_processed_volume"), "payment_method")
    )


def operations_audit(errors: DataFrame) -> DataFrame:
    """Dead letters by table, status and reason, most frequent first."""
    return (
        errors.groupBy("source_table", "validation_status", "validation_reason")
        .agg(
            F.count("*").alias("incident_count"),
            F.min("processing_timestamp").alias("first_seen"),
            F.max("processing_timestamp").alias("last_seen"),
        )
        .orderBy(F.desc("incident_count"), "source_table", "validation_reason")
    )


def category_rollup(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """Products, units, revenue and share of all item revenue per category."""
    categories = (
        product_performance_mart(products, order_items)
        .groupBy("category")
        .agg(
            F.count("product_id").alias("catalog_products"),
            F.coalesce(F.sum("total_units_sold"), F.lit(0)).alias("units_sold"),
            F.coalesce(sum_money("gross_revenue"), F.lit(0.0)).alias("gross_revenue"),
        )
    )
    # Whole cents, so that the total does not depend on the order of the categories.
    cents = F.col("gross_revenue").cast("decimal(38,2)")
    everything = F.sum(cents).over(Window.partitionBy(F.lit(1))).cast("double")
    return (
        categories.withColumn("_everything", everything)
        .withColumn("revenue_share_pct", percent2("gross_revenue", "_everything"))
        .drop("_everything")
        .orderBy(F.desc("gross_revenue"), "category")
    )


def top_products(products: DataFrame, order_items: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` products with the greatest revenue."""
    return (
        products.join(sales_by_product(order_items), "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "price",
            "total_units_sold",
            "gross_revenue",
        )
        .orderBy(F.desc("gross_revenue"), "product_id")
        .limit(k)
    )


def scorecard(
    orders: DataFrame, payments: DataFrame, products: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Key figures as ``(metric, value, detail)``.

    Revenue, order count and basket are over non-cancelled orders; active customers are
    those with at least one of them; the success rate is over all payments.
    """
    by_customer = (
        kept_orders(orders)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.count("total_amount").alias("amounts"),
            sum_money("total_amount").alias("revenue"),
        )
    )
    # count() of the group key leaves out the group of orders without a customer.
    sales = by_customer.agg(
        sum_money("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.try_divide(sum_money("revenue"), F.sum("amounts")).alias("basket"),
        F.count("customer_id").alias("customers"),
    )

    def metric(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))

    sales_rows = sales.select(
        F.explode(
            F.array(
                metric("gross_revenue", round2("revenue")),
                metric("valid_orders", F.col("orders")),
                metric("avg_basket_size", round2("basket")),
                metric("active_customers", F.col("customers")),
            )
        ).alias("m")
    ).select("m.metric", "m.value", F.lit(None).cast("string").alias("detail"))
    rate = percent2("count_if(payment_status = 'SUCCESS')", "count(payment_id)")
    payment_rows = payments.agg(rate.alias("value")).select(
        F.lit("payment_success_pct").alias("metric"),
        "value",
        F.lit(None).cast("string").alias("detail"),
    )
    top = category_rollup(products, order_items).limit(1)
    top_rows = top.select(
        F.lit("top_category_revenue").alias("metric"),
        round2("gross_revenue").alias("value"),
        F.col("category").alias("detail"),
    )
    return sales_rows.unionByName(payment_rows).unionByName(top_rows)


def status_aggregate(orders: DataFrame) -> DataFrame:
    """Orders and amount per status."""
    return orders.groupBy("order_status").agg(
        F.count("*").alias("order_count"), total_money("total_amount").alias("total_amount")
    )


def day_total(orders: DataFrame, day: str) -> DataFrame:
    """Amount of one day. On a table partitioned by ``order_date_dt`` only that day's
    folder is read."""
    return (
        orders.filter(F.col("order_date_dt") == F.lit(day).cast("date"))
        .agg(total_money("total_amount").alias("total_amount"))
        .select(F.lit(day).cast("date").alias("order_date_dt"), "total_amount")
    )


def city_revenue(orders: DataFrame, customers: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Amount per city of the customer.

    Orders are reduced to one row per customer before the join. A small customer table is
    then broadcast by its size; a large one meets already reduced rows.
    """
    spent = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(sum_money(amount).alias("_spent"))
    )
    return (
        spent.join(customers.select("customer_id", "city"), "customer_id")
        .groupBy("city")
        .agg(total_money("_spent").alias("revenue"))
    )


# Report name -> (function, views it reads).
REPORTS = {
    "daily_sales": (daily_sales, ("orders",)),
    "customer_lifetime_value": (customer_lifetime_value, ("customers", "orders")),
    "product_performance": (product_performance, ("products", "order_items")),
    "payment_summary": (payment_summary, ("payments",)),
    "operations_audit": (operations_audit, ("errors",)),
}


def run_report(spark: SparkSession, name: str, data_dir: str | None = None) -> DataFrame:
    """A report by name over the ``<table>_source`` views, registering them first if a
    lake folder is given. The views also serve plain ``spark.sql`` text."""
    if data_dir is not None:
        register_views(spark, data_dir)
    report, tables = REPORTS[name]
    return report(*[spark.table(f"{table}_source") for table in tables])
