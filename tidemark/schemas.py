"""Entities, change envelopes and the dead-letter record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Enumerations of the source system.
ORDER_STATUSES = (
    "PLACED",
    "CONFIRMED",
    "PROCESSING",
    "SHIPPED",
    "DELIVERED",
    "CANCELLED",
    "REFUNDED",
)
PAYMENT_STATUSES = ("SUCCESS", "PENDING", "FAILED", "REFUNDED")
PAYMENT_METHODS = ("CREDIT_CARD", "DEBIT_CARD", "UPI", "NET_BANKING", "WALLET", "COD")
CHANGE_OPERATIONS = ("c", "u", "d", "r")

CANCELLED = "CANCELLED"


def _struct(ddl: str) -> StructType:
    types = {
        "long": LongType(),
        "int": IntegerType(),
        "double": DoubleType(),
        "string": StringType(),
    }
    fields = (part.split() for part in ddl.split(","))
    return StructType([StructField(name, types[kind], True) for name, kind in fields])


@dataclass(frozen=True)
class Entity:
    """One replicated table: its payload, key and the layout of its silver copy."""

    name: str
    key: str
    payload: StructType
    partition_by: tuple[str, ...] = ()
    date_column: str | None = None
    version_column: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.payload.fieldNames()

    @property
    def topic(self) -> str:
        return f"ecommerce.public.{self.name}"


ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        Entity(
            "customers",
            "customer_id",
            _struct(
                "customer_id long, first_name string, last_name string, email string,"
                "city string, state string, created_at string, updated_at string"
            ),
            partition_by=("state",),
            version_column="updated_at",
        ),
        Entity(
            "products",
            "product_id",
            _struct(
                "product_id long, product_name string, category string, price double,"
                "stock_quantity int, created_at string, updated_at string"
            ),
            partition_by=("category",),
            version_column="updated_at",
        ),
        Entity(
            "orders",
            "order_id",
            _struct(
                "order_id long, customer_id long, order_status string, total_amount double,"
                "order_date string, updated_at string"
            ),
            partition_by=("order_status",),
            date_column="order_date",
            version_column="updated_at",
        ),
        Entity(
            "order_items",
            "order_item_id",
            _struct(
                "order_item_id long, order_id long, product_id long, quantity int,"
                "unit_price double"
            ),
        ),
        Entity(
            "payments",
            "payment_id",
            _struct(
                "payment_id long, order_id long, payment_method string,"
                "payment_status string, payment_amount double, payment_date string"
            ),
            partition_by=("payment_method",),
            version_column="payment_date",
        ),
    )
}

CORRUPT = "_corrupt_record"

SOURCE_BLOCK = _struct("db string, table string, txId long, lsn long")


def envelope_schema(payload: StructType) -> StructType:
    """The change envelope around ``payload``.

    ``operation`` is an accepted alias of ``op``; the corrupt-record field lets
    ``from_json`` report text that is not an envelope instead of hiding it.
    """
    return StructType(
        [
            StructField("op", StringType(), True),
            StructField("operation", StringType(), True),
            StructField("ts_ms", LongType(), True),
            StructField("before", payload, True),
            StructField("after", payload, True),
            StructField("source", SOURCE_BLOCK, True),
            StructField(CORRUPT, StringType(), True),
        ]
    )


# The one dead-letter shape every path writes.
ERRORS = _struct(
    "source_table string, record_id string, operation string, event_timestamp long,"
    "processing_timestamp string, pipeline_run_id string, validation_status string,"
    "validation_reason string, raw_payload string"
)

# Foreign keys: (child table, child column, parent table, parent key).
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
)
