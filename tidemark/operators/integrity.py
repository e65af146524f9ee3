"""Constraints of the source tables, checked on the lake."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bitmaps import KeyFilter

# CHECK constraints as (name, violated-when) per table; NOT NULL columns
# are listed in NOT_NULL.
CHECKS: dict[str, dict[str, str]] = {
    "products": {"price >= 0": "price < 0", "stock_quantity >= 0": "stock_quantity < 0"},
    "orders": {"total_amount >= 0": "total_amount < 0"},
    "order_items": {"quantity > 0": "quantity <= 0", "unit_price >= 0": "unit_price < 0"},
    "payments": {"payment_amount >= 0": "payment_amount < 0"},
}
NOT_NULL: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "first_name", "last_name", "email", "city", "state"),
    "products": ("product_id", "product_name", "category", "price", "stock_quantity"),
    "orders": ("order_id", "customer_id", "order_status", "total_amount", "order_date"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
    "payments": ("payment_id", "order_id", "payment_method", "payment_status", "payment_amount"),
}


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows. Nulls are distinct."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def constraint_violations(df: DataFrame, table: str) -> DataFrame:
    """``(source_table, constraint_name, violations)``, all constraints in one pass."""
    checks: dict[str, Column] = {
        f"{name} NOT NULL": F.col(name).isNull()
        for name in NOT_NULL.get(table, ())
        if name in df.columns
    }
    for name, violated in CHECKS.get(table, {}).items():
        checks[name] = F.expr(violated)
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.col(f"c{i}").alias("violations"))
            for i, name in enumerate(checks)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("source_table"), "r.constraint_name", "r.violations"
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent row, with their number of child rows.

    The child is reduced to one row per value before the join, so a value that fills a
    third of the table is a single row when it is shuffled for the join.
    """
    references = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("foreign_key"))
        .agg(F.count("*").alias("row_count"))
    )
    keys = parent.select(F.col(parent_key).alias("foreign_key"))
    return references.join(keys, "foreign_key", "left_anti")


def orphan_report(
    tables: Mapping[str, DataFrame], foreign_keys: tuple[tuple[str, str, str, str], ...]
) -> DataFrame:
    """Orphans per foreign key: distinct values and rows."""
    reports = []
    for child, column, parent, parent_key in foreign_keys:
        orphans = orphan_keys(tables[child], column, tables[parent], parent_key)
        reports.append(
            orphans.agg(
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
            ).select(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                "orphan_keys",
                "orphan_rows",
            )
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def duplicates_with_stored(stored: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Values of a new load that occur more than once in it and the stored table together:
    ``column, stored_rows, new_rows``. Nulls are distinct. Only stored rows that pass a filter
    of the new values are moved and compared."""
    values = (
        new.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("new_rows"))
    )
    possible = KeyFilter(values, column).passing(stored.select(column), column)
    held = possible.groupBy(column).agg(F.count("*").alias("stored_rows"))
    both = values.join(held, column, "left").fillna(0, ["stored_rows"])
    return both.filter(F.col("stored_rows") + F.col("new_rows") > 1).select(
        column, "stored_rows", "new_rows"
    )


def orphans_with_stored(
    child: DataFrame,
    column: str,
    stored_parent: DataFrame,
    parent_key: str,
    new_parent: DataFrame | None = None,
) -> DataFrame:
    """Foreign-key values of a new load without a parent, stored or loaded with it, and their
    number of child rows. Only stored parents that pass a filter of the references are moved."""
    references = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("foreign_key"))
        .agg(F.count("*").alias("row_count"))
    )
    parents = KeyFilter(references, "foreign_key").passing(stored_parent.select(parent_key), parent_key)
    if new_parent is not None:
        parents = parents.unionByName(new_parent.select(parent_key))
    keys = parents.select(F.col(parent_key).alias("foreign_key"))
    return references.join(keys, "foreign_key", "left_anti")
