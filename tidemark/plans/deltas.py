"""Gold marts that follow the changes: every change adds its new row and takes off its old
one, so a run scans its own changes and nothing else.

A run appends partial sums, as whole cents, below ``<gold>/_sums/<mart>``; a mart is the sum of
its partials, which are as many as it has keys, not as there are events. First and latest
order dates come from counts per customer and date, so that a delete gives back the date
before it. A run named twice replaces what it wrote, so it may be repeated; :func:`fold`
adds up the partials of finished runs.

Rows taken off must be those once added: the changes of :class:`~tidemark.sinks.keyed.KeyedTable`
merges. Amounts from 1e13 on or NaN cannot be taken off exactly: a sum that holds one is NaN.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import mean_of_sums, signed_sums, total_of_sums
from tidemark.functions.temporal import to_day
from tidemark.plans.marts import ITEM_VALUE, kept_orders
from tidemark.schemas import ENTITIES, Entity
from tidemark.session import remove_path
from tidemark.sinks.tables import write_mart
from tidemark.sources.tables import _entries, path_exists, read_parquet

WEIGHT = "_weight"


@dataclass(frozen=True)
class MartSums:
    """How one mart's partial sums are made: its entity, keys, and what is added up."""

    entity: str
    keys: tuple[str, ...]
    amount: str
    units: str | None = None


MARTS = {
    "daily_sales": MartSums("orders", ("order_date_dt", "order_status"), "total_amount"),
    "customer_lifetime_value": MartSums("orders", ("customer_id", "order_date"), "total_amount"),
    "product_performance": MartSums("order_items", ("product_id",), ITEM_VALUE, "quantity"),
    "payment_summary": MartSums("payments", ("payment_method", "payment_status"), "payment_amount"),
}
_SUMS = ("rows", "high", "low", "known", "inexact", "units", "units_known")


def signed_rows(changes: DataFrame, entity: Entity) -> DataFrame:
    """The rows of ``changes`` (structs ``old`` and ``new``) with their weight: 1 for a row
    that is there now, -1 for one that was. Deletes and their tombstones are no rows."""
    images = F.array(
        F.struct(F.col("new").alias("row"), F.lit(1).cast("long").alias(WEIGHT)),
        F.struct(F.col("old").alias("row"), F.lit(-1).cast("long").alias(WEIGHT)),
    )
    rows = changes.select(F.inline(images)).filter(F.col("row").isNotNull())
    if "operation" in changes.schema["new"].dataType.fieldNames():
        rows = rows.filter(F.lower("row.operation") != "d")
    names = [n for n in entity.columns if n in changes.schema["new"].dataType.fieldNames()]
    return rows.select(*[F.col(f"row.{name}").alias(name) for name in names], WEIGHT)


def all_rows(table: DataFrame) -> DataFrame:
    """A whole snapshot as additions, to start from."""
    return table.withColumn(WEIGHT, F.lit(1).cast("long"))


def partial_sums(rows: DataFrame, mart: str) -> DataFrame:
    """One row per key of the mart, of what ``rows`` with weights add to it. Keys whose
    additions and takings cancel out are left away."""
    plan = MARTS[mart]
    if plan.entity == "orders":
        rows = kept_orders(rows)
        date = F.col("order_date")
        rows = rows.withColumns(
            {"order_date_dt": to_day("order_date"), "order_date": date.try_cast("timestamp")}
        )
    if mart == "customer_lifetime_value":
        rows = rows.filter(F.col("customer_id").isNotNull())
    weight = F.col(WEIGHT)
    units = F.col(plan.units).cast("long") if plan.units else F.lit(None).cast("long")
    none = F.lit(0).cast("long")
    sums = rows.groupBy(*plan.keys).agg(
        F.sum(WEIGHT).alias("rows"),
        *[column.alias(name) for name, column in signed_sums(plan.amount, WEIGHT).items()],
        F.sum(F.coalesce(units * weight, none)).alias("units"),
        F.sum(F.when(units.isNotNull(), weight).otherwise(none)).alias("units_known"),
    )
    return sums.filter(" OR ".join(f"{name} <> 0" for name in _SUMS))


def _base(gold_base: str, mart: str) -> str:
    return f"{gold_base.rstrip('/')}/_sums/{mart}"


def _generation(spark: SparkSession, gold_base: str, mart: str) -> int:
    """The last generation whose fold was finished; 0 before the first fold."""
    base = _base(gold_base, mart)
    found = [int(name.split("=")[1]) for name, _ in _entries(spark, base) if name.startswith("generation=")]
    done = [g for g in found if path_exists(spark, f"{base}/generation={g}/run=fold/_SUCCESS")]
    return max(done, default=0)


def _folded(spark: SparkSession, gold_base: str, mart: str) -> DataFrame | None:
    generation = _generation(spark, gold_base, mart)
    return read_parquet(spark, f"{_base(gold_base, mart)}/_folded/generation={generation}")


def add_run(rows: DataFrame, gold_base: str, mart: str, run: str) -> bool:
    """Write what ``rows`` add to a mart as the partial sums of ``run``, in place of what a
    run of this name wrote before; False if it was folded already."""
    spark = rows.sparkSession
    folded = _folded(spark, gold_base, mart)
    if folded is not None and folded.filter(F.col("run") == run).limit(1).count():
        return False
    generation = _generation(spark, gold_base, mart)
    path = f"{_base(gold_base, mart)}/generation={generation}/run={run}"
    partial_sums(rows, mart).hint("rebalance").write.mode("overwrite").parquet(path)
    return True


def advance_marts(
    spark: SparkSession, gold_base: str, run: str, changes: Mapping[str, DataFrame]
) -> list[str]:
    """Add the changes of a run, by entity, to the sums of every mart they concern."""
    advanced = []
    for mart, plan in MARTS.items():
        if plan.entity in changes:
            rows = signed_rows(changes[plan.entity], ENTITIES[plan.entity])
            if add_run(rows, gold_base, mart, run):
                advanced.append(mart)
    return advanced


def mart_sums(spark: SparkSession, gold_base: str, mart: str) -> DataFrame:
    """The sums of all runs by key of the mart; keys without rows are left away."""
    keys = MARTS[mart].keys
    path = f"{_base(gold_base, mart)}/generation={_generation(spark, gold_base, mart)}"
    partials = spark.read.parquet(path)
    totals = partials.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _SUMS])
    return totals.filter("rows <> 0")


def fold(spark: SparkSession, gold_base: str, mart: str) -> int:
    """Add up the partial sums of all runs; returns the new generation. Not while a run is
    being added. Readers change over when the folded sums are complete; what they read before
    stays until the fold after."""
    base, before = _base(gold_base, mart), _generation(spark, gold_base, mart)
    names = [name[4:] for name, _ in _entries(spark, f"{base}/generation={before}") if name.startswith("run=")]
    runs = spark.createDataFrame([(name,) for name in names if name != "fold"], "run string")
    known = _folded(spark, gold_base, mart)
    runs = runs if known is None else runs.unionByName(known)
    after = before + 1
    runs.write.mode("overwrite").parquet(f"{base}/_folded/generation={after}")
    sums = mart_sums(spark, gold_base, mart).hint("rebalance")
    sums.write.mode("overwrite").parquet(f"{base}/generation={after}/run=fold")
    remove_path(spark, f"{base}/generation={before - 1}")
    return after


def _daily_sales(sums: DataFrame) -> DataFrame:
    return sums.select(
        "order_date_dt",
        "order_status",
        F.col("rows").alias("total_orders"),
        total_of_sums().alias("total_revenue"),
        mean_of_sums().alias("avg_order_value"),
    )


def _spending(sums: DataFrame) -> DataFrame:
    added = [F.sum(name).alias(name) for name in _SUMS]
    dates = (F.min("order_date").alias("first_order_date"), F.max("order_date").alias("latest_order_date"))
    return (
        sums.groupBy("customer_id")
        .agg(*added, *dates)
        .select(
            "customer_id",
            F.col("rows").alias("lifetime_orders"),
            total_of_sums().alias("lifetime_value"),
            mean_of_sums().alias("average_basket_size"),
            "first_order_date",
            "latest_order_date",
        )
    )


def _product_sales(sums: DataFrame) -> DataFrame:
    units: Column = F.when(F.col("units_known") != 0, F.col("units"))
    return sums.select(
        "product_id",
        units.alias("total_units_sold"),
        total_of_sums().alias("gross_revenue"),
    )


def _payment_summary(sums: DataFrame) -> DataFrame:
    return sums.select(
        "payment_method",
        "payment_status",
        F.col("rows").alias("transaction_count"),
        total_of_sums().alias("total_amount"),
        mean_of_sums().alias("avg_payment_amount"),
    )


_SHAPES = {
    "daily_sales": _daily_sales,
    "customer_lifetime_value": _spending,
    "product_performance": _product_sales,
    "payment_summary": _payment_summary,
}
# What a mart shows of the dimension it is about; every row of the dimension is in it.
_DIMENSIONS = {
    "customer_lifetime_value": ("customers", ("customer_id", "first_name", "last_name", "email", "city", "state")),
    "product_performance": ("products", ("product_id", "product_name", "category", "price", "stock_quantity")),
}


def current_mart(
    spark: SparkSession, gold_base: str, mart: str, dimensions: Mapping[str, DataFrame]
) -> DataFrame:
    """A mart from its sums, the same rows as a rebuild from the snapshots gives."""
    shown = _SHAPES[mart](mart_sums(spark, gold_base, mart))
    if mart not in _DIMENSIONS:
        return shown
    table, columns = _DIMENSIONS[mart]
    key = columns[0]
    figures = [name for name in shown.columns if name != key]
    return dimensions[table].join(shown, key, "left").select(*columns, *figures)


def write_marts(
    spark: SparkSession, gold_base: str, dimensions: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Replace the gold marts by what their sums give, as ``run_transformations`` does from
    the snapshots."""
    for mart in MARTS:
        rows = current_mart(spark, gold_base, mart, dimensions)
        write_mart(rows.withColumn("calculated_at", F.current_timestamp()), gold_base, mart)
    return {mart: spark.read.parquet(f"{gold_base.rstrip('/')}/{mart}") for mart in MARTS}
