"""Keyed writes into a snapshot: update some columns, or insert what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_greatest

# The columns each table's upsert overwrites.
UPSERT_COLUMNS = {
    "customers": ("updated_at",),
    "products": ("price",),
    "orders": ("order_status",),
    "payments": ("payment_status",),
}


def _one_per_key(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return keep_greatest(rows.filter(F.col(key).isNotNull()), [key], order)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """New snapshot: known keys take ``columns`` from the update, unknown keys are added
    whole, untouched keys stay. Of several updates of one key the greatest by ``order``
    wins. Both sides are unique by key, so the full join has no hot key."""
    known = target.withColumn("_known", F.lit(True))
    fresh = _one_per_key(updates, key, order).select(
        F.col(key),
        *[F.col(n).alias(f"_new_{n}") for n in target.columns if n != key],
        F.lit(True).alias("_fresh"),
    )

    def merged(name: str) -> Column:
        if name == key:
            return F.col(key)
        old, new = F.col(name), F.col(f"_new_{name}")
        if name in columns:
            return F.when(F.col("_fresh"), new).otherwise(old).alias(name)
        return F.when(F.col("_known"), old).otherwise(new).alias(name)

    return known.join(fresh, key, "full").select(*[merged(n) for n in target.columns])


def insert_if_absent(
    target: DataFrame, rows: DataFrame, key: str, order: Sequence[Column] = ()
) -> DataFrame:
    """Add rows whose key the target lacks; existing rows never change."""
    fresh = _one_per_key(rows, key, order).join(target.select(key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
