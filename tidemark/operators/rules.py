"""Quality rules as column expressions.

A rule says when a row fails and why. The rules of an entity stand in order and the
first failing one names the reason, so a whole rule set is one ``coalesce`` of
``when`` expressions: a projection without shuffle and without Python workers.

Three profiles are kept apart because they decide differently on the same row:

``record``    strict; null amounts and statuses fail, enumerations ignore case,
              reasons carry the offending value
``stream``    lenient; a null never fails a comparison, enumerations are
              case-sensitive, short reasons
``declared``  built from a rule dictionary (required fields, minima, enumerations)
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import (
    DECLARED_EMAIL_PATTERN,
    EMAIL_PATTERN,
    is_blank,
    is_email,
    is_non_negative,
    show_float,
    show_text,
)
from tidemark.schemas import ORDER_STATUSES, PAYMENT_METHODS, PAYMENT_STATUSES

VALID = "VALID"
INVALID = "INVALID"


# What a record says of a field that could not be read as its type, by field.
Texts = Mapping[str, Column]


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a bad row; null and false both pass."""

    fails: Column
    reason: Column


def rule(fails: Column, reason: Column | str) -> Rule:
    return Rule(fails, F.lit(reason) if isinstance(reason, str) else reason)


def first_failure(rules: Iterable[Rule]) -> Column:
    """The reason of the first failing rule, null when every rule passes."""
    branches = [F.when(r.fails, r.reason) for r in rules]
    return F.coalesce(*branches) if branches else F.lit(None).cast("string")


def any_failure(rules: Iterable[Rule]) -> Column:
    """Whether some rule fails; never null."""
    result = F.lit(False)
    for r in rules:
        result = result | F.coalesce(r.fails, F.lit(False))
    return result


def with_verdict(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add ``validation_status`` and ``validation_reason``.

    The status is built from the conditions, not from the reason, so that a filter on the
    status compares values only and never composes reason texts.
    """
    rules = list(rules)
    return df.withColumns(
        {
            "validation_reason": first_failure(rules),
            "validation_status": F.when(any_failure(rules), INVALID).otherwise(VALID),
        }
    )


# --- building blocks of the record profile -------------------------------------------


def _no_key(column: str) -> Rule:
    # A key of zero or an empty key counts as missing.
    value = F.col(column)
    return rule(
        value.isNull() | value.cast("string").isin("", "0"),
        f"{column} is NULL or missing",
    )


def _negative(
    column: str, texts: Texts, show: Callable[[Column], Column] = show_float
) -> Rule:
    shown = show(F.col(column))
    if column in texts:
        shown = F.coalesce(F.when(F.col(column).isNull(), texts[column]), shown)
    return rule(
        ~is_non_negative(F.col(column)),
        F.concat(F.lit(f"{column} must be >= 0, found: "), shown),
    )


def _unknown_value(column: str, allowed: Iterable[str], optional: bool = False) -> Rule:
    value = F.col(column)
    unknown = ~F.coalesce(F.upper(value).isin(*allowed), F.lit(False))
    if optional:
        unknown = value.isNotNull() & (value != "") & unknown
    listing = ", ".join(f"'{item}'" for item in sorted(allowed))
    return rule(
        unknown,
        F.concat(
            F.lit(f"invalid {column}: '"), show_text(value), F.lit(f"'. Allowed: [{listing}]")
        ),
    )


def _record_customers(texts: Texts) -> list[Rule]:
    email = F.col("email")
    return [
        _no_key("customer_id"),
        rule(email.isNull() | (email == ""), "email is missing"),
        rule(~is_email(email), F.concat(F.lit("invalid email format: '"), email, F.lit("'"))),
        rule(is_blank(F.col("first_name")), "first_name cannot be empty"),
    ]


def _record_products(texts: Texts) -> list[Rule]:
    return [
        _no_key("product_id"),
        _negative("price", texts),
        _negative("stock_quantity", texts, show_text),
        rule(is_blank(F.col("product_name")), "product_name cannot be empty"),
    ]


def _record_orders(texts: Texts) -> list[Rule]:
    return [
        _no_key("order_id"),
        _no_key("customer_id"),
        _unknown_value("order_status", ORDER_STATUSES),
        _negative("total_amount", texts),
    ]


def _record_payments(texts: Texts) -> list[Rule]:
    return [
        _no_key("payment_id"),
        _no_key("order_id"),
        _negative("payment_amount", texts),
        _unknown_value("payment_status", PAYMENT_STATUSES),
        _unknown_value("payment_method", PAYMENT_METHODS, optional=True),
    ]


# --- stream profile -------------------------------------------------------------------


def _stream_customers(texts: Texts) -> list[Rule]:
    email, first_name = F.col("email"), F.col("first_name")
    return [
        rule(email.isNull() | ~email.rlike(EMAIL_PATTERN), "invalid email format"),
        rule(first_name.isNull() | (first_name == ""), "missing first_name"),
    ]


def _stream_orders(texts: Texts) -> list[Rule]:
    return [
        rule(F.col("customer_id").isNull(), "customer_id is null"),
        rule(F.col("total_amount") < 0.0, "total_amount is negative"),
        rule(~F.col("order_status").isin(*ORDER_STATUSES), "invalid order_status enum"),
    ]


def _stream_payments(texts: Texts) -> list[Rule]:
    return [
        rule(F.col("payment_amount") < 0.0, "negative payment_amount"),
        rule(~F.col("payment_method").isin(*PAYMENT_METHODS), "invalid payment_method"),
        rule(~F.col("payment_status").isin(*PAYMENT_STATUSES), "invalid payment_status"),
    ]


# --- declared profile -----------------------------------------------------------------

# The declared rule set. The source writes it as YAML with the same names.
DECLARED_RULES: dict[str, dict] = {
    "customers": {
        "primary_key": "customer_id",
        "required_fields": ["customer_id", "email", "first_name", "last_name"],
        "email_regex": DECLARED_EMAIL_PATTERN,
    },
    "products": {
        "primary_key": "product_id",
        "required_fields": [
            "product_id",
            "product_name",
            "category",
            "price",
            "stock_quantity",
        ],
        "numeric_ranges": {"price": {"min": 0.0}, "stock_quantity": {"min": 0}},
    },
    "orders": {
        "primary_key": "order_id",
        "required_fields": ["order_id", "customer_id", "order_status", "total_amount"],
        "numeric_ranges": {"total_amount": {"min": 0.0}},
        "allowed_statuses": list(ORDER_STATUSES),
    },
    "payments": {
        "primary_key": "payment_id",
        "required_fields": [
            "payment_id",
            "order_id",
            "payment_method",
            "payment_status",
            "payment_amount",
        ],
        "numeric_ranges": {"payment_amount": {"min": 0.0}},
        "allowed_methods": list(PAYMENT_METHODS),
        "allowed_statuses": list(PAYMENT_STATUSES),
    },
}

_STATUS_COLUMN = {"orders": "order_status", "payments": "payment_status"}


def declared_rules(table: str, declaration: Mapping[str, Mapping] | None = None) -> list[Rule]:
    """Rules of one table of a declaration: required fields, then minima, then
    patterns and enumerations. An unknown table has no rules."""
    spec = (declaration or DECLARED_RULES).get(table, {})
    rules = [
        rule(F.col(name).isNull(), f"required field {name} is missing")
        for name in spec.get("required_fields", ())
    ]
    for name, bounds in spec.get("numeric_ranges", {}).items():
        if "min" in bounds:
            x = F.col(name).try_cast("double")
            rules.append(
                rule(F.isnan(x) | (x < float(bounds["min"])), f"{name} below minimum {bounds['min']}")
            )
    if "email_regex" in spec:
        rules.append(rule(~F.col("email").rlike(spec["email_regex"]), "invalid email"))
    if "allowed_methods" in spec:
        rules.append(
            rule(~F.col("payment_method").isin(*spec["allowed_methods"]), "invalid payment_method")
        )
    if "allowed_statuses" in spec:
        status = _STATUS_COLUMN.get(table, "status")
        rules.append(rule(~F.col(status).isin(*spec["allowed_statuses"]), f"invalid {status}"))
    if "allowed_operations" in spec:
        rules.append(
            rule(
                ~F.coalesce(F.lower("operation").isin(*spec["allowed_operations"]), F.lit(False)),
                "invalid operation",
            )
        )
    return rules


def load_declaration(path: str) -> dict[str, dict]:
    """Read the ``rules`` block of a local YAML declaration."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)["rules"]


_PROFILES: dict[str, dict[str, Callable[[Texts], list[Rule]]]] = {
    "record": {
        "customers": _record_customers,
        "products": _record_products,
        "orders": _record_orders,
        "payments": _record_payments,
    },
    "stream": {
        "customers": _stream_customers,
        "orders": _stream_orders,
        "payments": _stream_payments,
    },
}


def rules_for(
    table: str,
    profile: str = "record",
    declaration: Mapping[str, Mapping] | None = None,
    texts: Texts | None = None,
) -> list[Rule]:
    """The rules of ``table``; a table without rules is valid throughout.

    Products have no rules of their own in the stream profile and use the record ones.
    ``declaration`` is for the declared profile, ``texts`` for the reasons of the others.
    """
    if profile == "declared":
        return declared_rules(table, declaration)
    if profile not in _PROFILES:
        raise ValueError(f"unknown rule profile: {profile}")
    build = _PROFILES[profile].get(table) or (
        _PROFILES["record"].get(table) if table == "products" else None
    )
    return build(texts or {}) if build else []


def validate(
    df: DataFrame,
    table: str,
    profile: str = "record",
    declaration: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Judge every row of an entity frame. A declared list of operations applies to frames
    that have the column."""
    if declaration and "operation" not in df.columns:
        declaration = {
            name: {k: v for k, v in spec.items() if k != "allowed_operations"}
            for name, spec in declaration.items()
        }
    return with_verdict(df, rules_for(table, profile, declaration))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("validation_status") == VALID)


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("validation_status") == INVALID)
