import pytest
from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.operators.integrity import constraint_violations, duplicate_values, orphan_keys
from tidemark.operators.quality import (
    QualityGateError,
    quality_gate,
    quality_score,
    tier_audit,
)
from tidemark.schemas import ENTITIES


def rows_of(spark, table, *records):
    schema = ENTITIES[table].payload
    return spark.createDataFrame(
        [tuple(r.get(n) for n in schema.fieldNames()) for r in records], schema
    )


def verdict(spark, table, record, profile="record"):
    row = rules.validate(rows_of(spark, table, record), table, profile).first()
    return row.validation_status, row.validation_reason


CUSTOMER = dict(
    customer_id=101, first_name="Rohan", last_name="Verma", email="rohan.verma@example.com",
    city="Bengaluru", state="Karnataka",
)
ORDER = dict(order_id=5001, customer_id=101, order_status="PLACED", total_amount=2499.5)
PRODUCT = dict(
    product_id=201, product_name="Mechanical Keyboard", category="Accessories", price=4999.0,
    stock_quantity=50,
)
PAYMENT = dict(
    payment_id=801, order_id=5001, payment_method="UPI", payment_status="SUCCESS",
    payment_amount=2499.5,
)
ORDER_LIST = "['CANCELLED', 'CONFIRMED', 'DELIVERED', 'PLACED', 'PROCESSING', 'REFUNDED', 'SHIPPED']"


@pytest.mark.parametrize(
    "table, record",
    [("customers", CUSTOMER), ("orders", ORDER), ("products", PRODUCT), ("payments", PAYMENT)],
)
@pytest.mark.parametrize("profile", ["record", "stream", "declared"])
def test_good_records(spark, table, record, profile):
    assert verdict(spark, table, record, profile) == ("VALID", None)


@pytest.mark.parametrize(
    "table, base, change, reason",
    [
        ("customers", CUSTOMER, {"customer_id": None}, "customer_id is NULL or missing"),
        ("customers", CUSTOMER, {"customer_id": 0}, "customer_id is NULL or missing"),
        ("customers", CUSTOMER, {"email": ""}, "email is missing"),
        ("customers", CUSTOMER, {"email": "not-an-email-address"},
         "invalid email format: 'not-an-email-address'"),
        ("customers", CUSTOMER, {"first_name": " \t"}, "first_name cannot be empty"),
        ("orders", ORDER, {"order_id": None}, "order_id is NULL or missing"),
        ("orders", ORDER, {"customer_id": None}, "customer_id is NULL or missing"),
        ("orders", ORDER, {"total_amount": -150.0}, "total_amount must be >= 0, found: -150.0"),
        ("orders", ORDER, {"total_amount": None}, "total_amount must be >= 0, found: None"),
        ("orders", ORDER, {"total_amount": float("nan")}, "total_amount must be >= 0, found: nan"),
        ("orders", ORDER, {"order_status": "UNKNOWN_STATUS"},
         f"invalid order_status: 'UNKNOWN_STATUS'. Allowed: {ORDER_LIST}"),
        ("orders", ORDER, {"order_status": None}, f"invalid order_status: 'None'. Allowed: {ORDER_LIST}"),
        ("products", PRODUCT, {"price": -10.0}, "price must be >= 0, found: -10.0"),
        ("products", PRODUCT, {"stock_quantity": -5}, "stock_quantity must be >= 0, found: -5"),
        ("products", PRODUCT, {"product_name": None}, "product_name cannot be empty"),
        ("payments", PAYMENT, {"payment_status": "INVALID_STATE"},
         "invalid payment_status: 'INVALID_STATE'. Allowed: ['FAILED', 'PENDING', 'REFUNDED', 'SUCCESS']"),
        ("payments", PAYMENT, {"payment_method": "CASH"},
         "invalid payment_method: 'CASH'. Allowed: "
         "['COD', 'CREDIT_CARD', 'DEBIT_CARD', 'NET_BANKING', 'UPI', 'WALLET']"),
    ],
)
def test_bad_records(spark, table, base, change, reason):
    assert verdict(spark, table, {**base, **change}) == ("INVALID", reason)


@pytest.mark.parametrize(
    "table, base, change",
    [
        ("orders", ORDER, {"order_status": "placed"}),
        ("payments", PAYMENT, {"payment_method": None}),
        ("payments", PAYMENT, {"payment_method": ""}),
        ("customers", CUSTOMER, {"email": "  a@b.co\n"}),
    ],
)
def test_record_profile_accepts(spark, table, base, change):
    assert verdict(spark, table, {**base, **change})[0] == "VALID"


@pytest.mark.parametrize(
    "table, base, change, reason",
    [
        ("orders", ORDER, {"total_amount": None, "order_status": None}, None),
        ("orders", ORDER, {"order_status": "placed"}, "invalid order_status enum"),
        ("orders", ORDER, {"customer_id": None, "total_amount": -1.0}, "customer_id is null"),
        ("orders", ORDER, {"total_amount": -1.0, "order_status": "X"}, "total_amount is negative"),
        ("payments", PAYMENT, {"payment_method": "X", "payment_status": "X"}, "invalid payment_method"),
        ("payments", PAYMENT, {"payment_amount": None, "payment_status": None}, None),
        ("customers", CUSTOMER, {"email": " a@b.co"}, "invalid email format"),
        ("customers", CUSTOMER, {"email": "a@b.co\n"}, None),
        ("customers", CUSTOMER, {"first_name": ""}, "missing first_name"),
        ("customers", CUSTOMER, {"first_name": "  "}, None),
    ],
)
def test_stream_profile(spark, table, base, change, reason):
    assert verdict(spark, table, {**base, **change}, "stream")[1] == reason


def test_rule_order_differs_between_profiles(spark):
    both = {**ORDER, "total_amount": -1.0, "order_status": "X"}
    assert verdict(spark, "orders", both)[1].startswith("invalid order_status")
    both = {**PAYMENT, "payment_method": "X", "payment_status": "X"}
    assert verdict(spark, "payments", both)[1].startswith("invalid payment_status")


def test_declared_profile(spark):
    assert verdict(spark, "customers", {**CUSTOMER, "last_name": None}, "declared")[1] == (
        "required field last_name is missing"
    )
    assert verdict(spark, "customers", {**CUSTOMER, "email": "a@b.c"}, "declared")[0] == "INVALID"
    assert verdict(spark, "products", {**PRODUCT, "price": -1.0}, "declared")[1] == (
        "price below minimum 0.0"
    )


def test_declaration_with_operations(spark):
    spec = {"orders": {"allowed_operations": ["c", "u"]}}
    df = rows_of(spark, "orders", ORDER).withColumn("operation", F.lit("D"))
    assert rules.with_verdict(df, rules.declared_rules("orders", spec)).first().validation_reason == (
        "invalid operation"
    )


def test_declaration_file(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yaml"
    path.write_text('rules:\n  orders:\n    required_fields: ["order_id"]\n')
    assert rules.load_declaration(str(path)) == {"orders": {"required_fields": ["order_id"]}}


def test_table_without_rules_is_valid(spark):
    assert verdict(spark, "order_items", {}) == ("VALID", None)
    with pytest.raises(ValueError):
        rules.rules_for("orders", "unheard-of")


def test_fork_loses_nothing(spark):
    df = rows_of(spark, "orders", ORDER, {**ORDER, "total_amount": -1.0}, {**ORDER, "customer_id": None})
    judged = rules.validate(df, "orders")
    assert rules.valid_rows(judged).count() == 1
    assert rules.invalid_rows(judged).count() == 2


def test_score_and_gate(spark):
    good = rows_of(spark, "orders", *[ORDER] * 19)
    bad = rows_of(spark, "orders", {**ORDER, "total_amount": -1.0})
    assert quality_gate(good, "orders") == 19
    with pytest.raises(QualityGateError, match="1 invalid rows.*found: -1.0"):
        quality_gate(good.union(bad), "orders")
    score = quality_score({"orders": rules.validate(good.union(bad), "orders")}).first()
    assert (score.total_count, score.dq_score, score.below_sla, score.error_alert) == (
        20, 95.0, False, False,
    )


def test_tier_audit(spark):
    df = spark.createDataFrame([("a",), ("b",)], "stamp string")
    found = {r.tier: tuple(r)[1:] for r in tier_audit({"gold": df, "bronze": None}, {"gold": "stamp"}).collect()}
    assert found == {"gold": (True, 2, "b"), "bronze": (False, 0, None)}


def test_integrity(spark):
    a, b = {**CUSTOMER, "customer_id": 1}, {**CUSTOMER, "customer_id": 2, "city": None}
    customers = rows_of(spark, "customers", a, b, {**a, "customer_id": 3, "email": None})
    assert [tuple(r) for r in duplicate_values(customers, "email").collect()] == [
        ("rohan.verma@example.com", 2)
    ]
    found = {r.constraint_name: r.violations for r in constraint_violations(customers, "customers").collect()}
    assert found["city NOT NULL"] == 1 and found["email NOT NULL"] == 1 and found["state NOT NULL"] == 0
    orders = rows_of(spark, "orders", *[{**ORDER, "customer_id": 9}] * 3, {**ORDER, "customer_id": 1},
                     {**ORDER, "customer_id": None})
    orphans = orphan_keys(orders, "customer_id", customers, "customer_id").collect()
    assert [tuple(r) for r in orphans] == [(9, 3)]
