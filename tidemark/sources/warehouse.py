"""Entities read from a star-schema warehouse (customer, nation, region, part, orders,
lineitem) instead of the shop's own tables.

The mapping keeps every row. With ``poison=True`` it also plants the defects the quality
rules look for, by replacing single values; keys start at 1 because 0 counts as missing.
Some references are moved to a neighbour so that customers without orders and products
without sales exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.project import compute_once


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _every(key: Column, modulus: int, rest: int) -> Column:
    return key % modulus == rest


def _entity(df: DataFrame, poison: bool, columns: Sequence[str] | None) -> DataFrame:
    # Planted defects are long expressions; rules filtering on them should not repeat them.
    # Columns nobody needs go before that, for the scan does not see past it.
    wanted = df.select(*columns) if columns else df
    return compute_once(wanted) if poison else wanted


def _poisoned(poison: bool, value: Column, *defects: tuple[Column, Column]) -> Column:
    if not poison:
        return value
    chain = None
    for condition, replacement in defects:
        chain = (
            F.when(condition, replacement) if chain is None else chain.when(condition, replacement)
        )
    return chain.otherwise(value)


def customers(
    spark: SparkSession, sf_dir: str, poison: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    k = F.col("c_custkey")
    name = F.split("c_name", "#")
    address = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))), F.lit("@example.com"))
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    people = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    listed = people.join(places, people.c_nationkey == places.n_nationkey).select(
        _poisoned(poison, k + 1, (_every(k, 40, 7), F.lit(None))).alias("customer_id"),
        _poisoned(poison, name[0], (_every(k, 45, 11), F.lit("   "))).alias("first_name"),
        name[1].alias("last_name"),
        _poisoned(
            poison,
            address,
            (_every(k, 30, 3), F.lit("not-an-email")),
            (_every(k, 50, 9), F.lit(None)),
        ).alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
    )
    return _entity(listed, poison, columns)


def products(
    spark: SparkSession, sf_dir: str, poison: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    k = F.col("p_partkey")
    listed = _read(spark, sf_dir, "part").select(
        (k + 1).alias("product_id"),
        _poisoned(poison, F.col("p_name"), (_every(k, 59, 8), F.lit(" "))).alias("product_name"),
        F.col("p_type").alias("category"),
        _poisoned(
            poison,
            F.col("p_retailprice"),
            (_every(k, 71, 6), -F.col("p_retailprice")),
            (_every(k, 73, 2), F.lit(None)),
        ).alias("price"),
        _poisoned(
            poison,
            F.col("p_size"),
            (_every(k, 67, 4), -F.col("p_size")),
            (_every(k, 79, 1), F.lit(None)),
        ).alias("stock_quantity"),
    )
    return _entity(listed, poison, columns)


# The status an order has, by key.
_STATUS_CYCLE = (
    "PLACED",
    "CONFIRMED",
    "PROCESSING",
    "SHIPPED",
    "DELIVERED",
    "CANCELLED",
    "REFUNDED",
    "DELIVERED",
)


def _order_columns(poison: bool) -> list[Column]:
    k, account = F.col("o_orderkey"), F.col("o_custkey")
    cycle = F.array(*[F.lit(s) for s in _STATUS_CYCLE])
    owner = account + F.when(account % 10 == 3, 2).otherwise(1)
    amount = F.col("o_totalprice")
    return [
        (k + 1).alias("order_id"),
        _poisoned(poison, owner, (_every(k, 83, 5), F.lit(None))).alias("customer_id"),
        _poisoned(
            poison,
            F.get(cycle, (k % 8).cast("int")),
            (_every(k, 97, 13), F.lit("CORRUPTED_STATUS")),
            (_every(k, 101, 17), F.lit(None)),
            (_every(k, 103, 19), F.lit("placed")),
        ).alias("order_status"),
        _poisoned(
            poison, amount, (_every(k, 89, 7), -amount), (_every(k, 107, 23), F.lit(None))
        ).alias("total_amount"),
        F.col("o_orderdate").alias("order_date"),
    ]


def orders(
    spark: SparkSession, sf_dir: str, poison: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    listed = _read(spark, sf_dir, "orders").select(*_order_columns(poison))
    return _entity(listed, poison, columns)


def order_items(
    spark: SparkSession, sf_dir: str, poison: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    """Line items. ``order_item_id`` repeats with different values, as the warehouse has
    several rows per (order, line)."""
    k = F.col("l_orderkey")
    product = F.col("l_partkey")
    listed = _read(spark, sf_dir, "lineitem").select(
        (k * 8 + F.col("l_linenumber")).alias("order_item_id"),
        _poisoned(poison, k + 1, (_every(F.col("l_suppkey"), 97, 5), -k - 1)).alias("order_id"),
        (product + F.when(product % 10 == 4, 2).otherwise(1)).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").alias("shipped_at"),
    )
    return listed.select(*columns) if columns else listed


def _payment_columns(poison: bool) -> list[Column]:
    k = F.col("o_orderkey")
    priority = F.col("o_orderpriority")
    method = (
        F.when(priority == "1-URGENT", "CREDIT_CARD")
        .when(priority == "2-HIGH", "UPI")
        .when(priority == "3-MEDIUM", "NET_BANKING")
        .when(priority == "4-NOT SPECIFIED", "DEBIT_CARD")
        .otherwise("WALLET")
    )
    status = (
        F.when(k % 6 < 4, F.lit("SUCCESS"))
        .when(k % 6 == 4, F.lit("PENDING"))
        .otherwise(F.lit("FAILED"))
    )
    return [
        (k + 1).alias("payment_id"),
        (k + 1).alias("order_id"),
        _poisoned(
            poison,
            method,
            (_every(k, 61, 4), F.lit(None)),
            (_every(k, 67, 9), F.lit("upi")),
            (_every(k, 73, 2), F.lit("CASH")),
        ).alias("payment_method"),
        _poisoned(
            poison,
            status,
            (_every(k, 71, 5), F.lit("UNKNOWN_STATE")),
            (_every(k, 109, 6), F.lit(None)),
        ).alias("payment_status"),
        _poisoned(poison, F.col("o_totalprice"), (_every(k, 79, 3), F.lit(-500.0))).alias(
            "payment_amount"
        ),
        F.col("o_orderdate").alias("payment_date"),
    ]


def payments(
    spark: SparkSession, sf_dir: str, poison: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    listed = _read(spark, sf_dir, "orders").select(*_payment_columns(poison))
    return _entity(listed, poison, columns)


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def _epoch_ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def order_messages(raw_orders: DataFrame, poison: bool = True) -> DataFrame:
    """The order table as a change log of ``(key, value)`` messages.

    Every order is created; urgent creations are sent twice; filled orders (``F``) are
    updated to DELIVERED a millisecond later, those of high priority in the same
    millisecond again to SHIPPED; low-priority pending orders are deleted another
    millisecond later. Planted among the creations: text that is no envelope, messages
    without a value, and amounts that are text. The frame may be a stream.
    """
    k = F.col("o_orderkey")
    flat = raw_orders.select(*_order_columns(poison), k, "o_orderstatus", "o_orderpriority")
    image = F.struct(
        _poisoned(poison, F.col("order_id"), (_every(k, 131, 7), F.lit(None))).alias("order_id"),
        "customer_id",
        "order_status",
        "total_amount",
        _iso("order_date").alias("order_date"),
        _iso("order_date").alias("updated_at"),
    )
    updated = image.withField("order_status", F.lit("DELIVERED"))
    shipped = image.withField("order_status", F.lit("SHIPPED"))
    nothing = F.lit(None).cast(
        "struct<order_id:bigint,customer_id:bigint,order_status:string,total_amount:double,"
        "order_date:string,updated_at:string>"
    )
    created = _poisoned(poison, image, (_every(k, 127, 5), nothing))
    start = _epoch_ms("order_date")

    def event(op: Column, step: int, before: Column, after: Column, place: int) -> Column:
        return F.struct(
            op.alias("op"),
            (start + step).alias("ts_ms"),
            before.alias("before"),
            after.alias("after"),
            F.struct(
                F.lit("shop").alias("db"),
                F.lit("orders").alias("table"),
                (k * 4 + place).alias("lsn"),
            ).alias("source"),
        )

    create_op = _poisoned(poison, F.lit("c"), (_every(k, 137, 3), F.lit("x")))
    creation = event(create_op, 0, nothing, created, 0)
    events = F.array(
        creation,
        F.when(F.col("o_orderpriority") == "1-URGENT", creation),
        F.when(F.col("o_orderstatus") == "F", event(F.lit("u"), 1, image, updated, 1)),
        F.when(
            (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH"),
            event(F.lit("u"), 1, updated, shipped, 3),
        ),
        F.when(
            (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"),
            event(F.lit("d"), 2, image, nothing, 2),
        ),
    )
    garbage = _every(k, 113, 8) & (F.col("e.op") == "c")
    creations = F.col("e.op").isin("c", "x")
    text = F.to_json("e")
    wordy = F.regexp_replace(text, r'"total_amount":[-0-9.E]+', '"total_amount":"abc"')
    return flat.select(k, F.explode(F.array_compact(events)).alias("e")).select(
        (k + 1).cast("string").alias("key"),
        _poisoned(
            poison,
            text,
            (garbage, F.concat(F.lit("garbage "), k.cast("string"))),
            (creations & _every(k, 149, 11), F.lit(None)),
            (creations & _every(k, 151, 21), wordy),
        ).alias("value"),
    )


# Event time of entities without a date: the start of 2024.
SNAPSHOT_MS = 1_704_067_200_000


def entity_messages(rows: DataFrame, table: str, key: str, date_column: str | None) -> DataFrame:
    """Any entity frame as creation messages, for the pipelines of the other tables."""
    columns = [
        _iso(name).alias(name) if name == date_column else F.col(name) for name in rows.columns
    ]
    stamp = _epoch_ms(date_column) if date_column else F.lit(SNAPSHOT_MS)
    envelope = F.struct(
        F.lit("c").alias("op"),
        stamp.alias("ts_ms"),
        F.struct(*columns).alias("after"),
        F.struct(F.lit("shop").alias("db"), F.lit(table).alias("table")).alias("source"),
    )
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(envelope).alias("value"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with its transport delay: ``value`` seconds, a minute each for
    errors."""
    event_ms = _epoch_ms("ts")
    seconds = F.when(F.col("event_type") == "error", F.col("value") * 60).otherwise(F.col("value"))
    return _read(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        event_ms.alias("event_ms"),
        (event_ms + F.floor(seconds * 1000)).alias("arrival_ms"),
    )
