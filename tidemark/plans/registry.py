"""Every query by name, over the warehouse tables of one folder.

Each entry takes ``(spark, sf_dir)`` and reads whole tables. Results carry no clock
values, so they can be compared with SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import month_key, to_day
from tidemark.operators import envelope, integrity, lateness, merge, quality, rules, skew, state
from tidemark.operators.deadletter import dead_letters
from tidemark.operators.dedup import distinct_events, distinct_events_stream, merge_batches, snapshot
from tidemark.operators.transitions import status_transitions as transitions_of
from tidemark.plans import deltas, ingest, marts, reports, writes
from tidemark.schemas import ENTITIES, FOREIGN_KEYS
from tidemark.session import apply_settings, scratch_dir, staged
from tidemark.sinks import tables as sinks
from tidemark.sinks import upkeep
from tidemark.sources import tables as inputs
from tidemark.sources import warehouse as wh
from tidemark.sources.streams import landed_messages
from tidemark.streaming import fork, pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDERS = ENTITIES["orders"]
_STAMP = "2024-01-01 00:00:00"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        streams = build.__name__.startswith("stream_")
        return build(apply_settings(spark, streaming=streams), sf_dir)

    QUERIES[build.__name__] = run
    return run


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _raw_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table file as a stream; a file source wants a pattern, not a file."""
    schema = _raw(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{table}*.parquet")


# --- reports ---------------------------------------------------------------------------


@query
def daily_sales(spark, sf_dir):
    return reports.daily_sales(wh.orders(spark, sf_dir))


@query
def top_revenue_days(spark, sf_dir):
    return reports.top_revenue_days(wh.orders(spark, sf_dir))


@query
def customer_lifetime_value(spark, sf_dir):
    return reports.customer_lifetime_value(wh.customers(spark, sf_dir), wh.orders(spark, sf_dir))


@query
def clv_inner(spark, sf_dir):
    return reports.best_customers(wh.customers(spark, sf_dir), wh.orders(spark, sf_dir))


@query
def product_performance(spark, sf_dir):
    return reports.product_performance(wh.products(spark, sf_dir), wh.order_items(spark, sf_dir))


@query
def payment_summary(spark, sf_dir):
    return reports.payment_summary(wh.payments(spark, sf_dir))


def _all_errors(spark, sf_dir):
    """Dead letters of all tables; the record's own date stands for the time of the run."""
    stamps = {
        "customers": F.lit(_STAMP).cast("timestamp"),
        "products": F.lit(_STAMP).cast("timestamp"),
        "orders": F.col("order_date").cast("timestamp"),
        "payments": F.col("payment_date").cast("timestamp"),
    }
    return _union(
        [
            dead_letters(df, ENTITIES[table], "audit", stamps[table])
            for table, df in _judged(spark, sf_dir).items()
        ]
    )


@query
def operations_audit(spark, sf_dir):
    return reports.operations_audit(_all_errors(spark, sf_dir))


@query
def scorecard(spark, sf_dir):
    return reports.scorecard(
        wh.orders(spark, sf_dir),
        wh.payments(spark, sf_dir),
        wh.products(spark, sf_dir),
        wh.order_items(spark, sf_dir),
    )


@query
def category_rollup(spark, sf_dir):
    return reports.category_rollup(wh.products(spark, sf_dir), wh.order_items(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return reports.top_products(wh.products(spark, sf_dir), wh.order_items(spark, sf_dir))


@query
def status_aggregate(spark, sf_dir):
    return reports.status_aggregate(wh.orders(spark, sf_dir))


@query
def status_aggregate_csv(spark, sf_dir):
    """The status aggregate on a CSV export of the orders."""
    path = sinks.export_csv(wh.orders(spark, sf_dir), scratch_dir(spark, "csv"), "orders")
    return reports.status_aggregate(inputs.read_csv(spark, path, ORDERS.payload))


PRUNED_DAY = "1998-08-02"


@query
def partition_pruned_sum(spark, sf_dir):
    """One day's total from a table partitioned by month: one folder is read, and the day
    is pushed down into its files."""
    path = scratch_dir(spark, "orders_by_month")
    day = to_day("order_date")
    dated = wh.orders(spark, sf_dir).withColumns(
        {"order_date_dt": day, "order_month": month_key(day)}
    )
    sinks.write_table(dated, path, ["order_month"])
    return reports.day_total(
        inputs.read_partition(spark, path, order_month=PRUNED_DAY[:7]), PRUNED_DAY
    )


@query
def clustered_day_sum(spark, sf_dir):
    """The same day's total from a table clustered by day and customer: its files' and pages'
    statistics leave out most of it, without a folder per month."""
    path = scratch_dir(spark, "orders_clustered")
    dated = wh.orders(spark, sf_dir).withColumn("order_date_dt", to_day("order_date"))
    upkeep.write_clustered(dated, path, ["order_date_dt", "customer_id"])
    return reports.day_total(spark.read.parquet(path), PRUNED_DAY)


@query
def city_revenue(spark, sf_dir):
    return reports.city_revenue(wh.orders(spark, sf_dir), wh.customers(spark, sf_dir))


# --- marts -----------------------------------------------------------------------------


@query
def mart_daily_sales(spark, sf_dir):
    return marts.daily_sales_mart(wh.orders(spark, sf_dir))


@query
def mart_customer_lifetime_value(spark, sf_dir):
    return marts.customer_lifetime_value_mart(
        wh.customers(spark, sf_dir), wh.orders(spark, sf_dir)
    )


@query
def mart_customer_ranking(spark, sf_dir):
    mart = marts.customer_lifetime_value_mart(wh.customers(spark, sf_dir), wh.orders(spark, sf_dir))
    return marts.ranked_customers(mart).select("customer_id", "lifetime_value", "clv_rank")


@query
def mart_product_performance(spark, sf_dir):
    return marts.product_performance_mart(
        wh.products(spark, sf_dir), wh.order_items(spark, sf_dir)
    )


@query
def mart_payment_summary(spark, sf_dir):
    return marts.payment_summary_mart(wh.payments(spark, sf_dir))


@query
def mart_payment_success(spark, sf_dir):
    return marts.with_success_rate(marts.payment_summary_mart(wh.payments(spark, sf_dir)))


_MART_SUMS = {
    "daily_sales": ("total_revenue", "total_orders"),
    "customer_lifetime_value": ("lifetime_value", "lifetime_orders"),
    "product_performance": ("gross_revenue", "total_units_sold"),
    "payment_summary": ("total_amount", "transaction_count"),
}


def _exact_sum(name):
    return F.sum(F.col(name).cast("decimal(38,2)")).cast("double")


@query
def gold_tables(spark, sf_dir):
    """Rows and sums per mart after the silver-to-gold job has run on written silver
    tables."""
    base = scratch_dir(spark, "lake")
    for name, df in {
        "customers": wh.customers(spark, sf_dir),
        "products": wh.products(spark, sf_dir),
        "orders": wh.orders(spark, sf_dir),
        "order_items": wh.order_items(spark, sf_dir),
        "payments": wh.payments(spark, sf_dir),
    }.items():
        sinks.write_table(df, f"{base}/silver/{name}", ENTITIES[name].partition_by)
    built = marts.run_transformations(spark, f"{base}/silver", f"{base}/gold")
    return _union(
        [
            df.agg(
                F.count("*").alias("row_count"),
                _exact_sum(_MART_SUMS[name][0]).alias("amount"),
                F.sum(_MART_SUMS[name][1]).alias("units"),
            ).select(F.lit(name).alias("mart"), "row_count", "amount", "units")
            for name, df in built.items()
        ]
    )


# --- quality ---------------------------------------------------------------------------


def _entities(spark, sf_dir):
    return {
        "customers": wh.customers(spark, sf_dir, poison=True),
        "products": wh.products(spark, sf_dir, poison=True),
        "orders": wh.orders(spark, sf_dir, poison=True),
        "payments": wh.payments(spark, sf_dir, poison=True),
    }


def _judged(spark, sf_dir, profile="record"):
    return {t: rules.validate(df, t, profile) for t, df in _entities(spark, sf_dir).items()}


_SHOWN = {
    "customers": ["customer_id", "first_name", "last_name", "email"],
    "products": ["product_id", "product_name", "price", "stock_quantity"],
    "orders": ["order_id", "customer_id", "order_status", "total_amount"],
    "payments": ["payment_id", "payment_method", "payment_status", "payment_amount"],
}


def _verdicts(spark, sf_dir, table, profile):
    df = getattr(wh, table)(spark, sf_dir, poison=True)
    return rules.validate(df, table, profile).select(
        *_SHOWN[table], "validation_status", "validation_reason"
    )


@query
def dq_customers(spark, sf_dir):
    return _verdicts(spark, sf_dir, "customers", "record")


@query
def dq_products(spark, sf_dir):
    return _verdicts(spark, sf_dir, "products", "record")


@query
def dq_orders(spark, sf_dir):
    return _verdicts(spark, sf_dir, "orders", "record")


@query
def dq_payments(spark, sf_dir):
    return _verdicts(spark, sf_dir, "payments", "record")


@query
def dq_customers_stream(spark, sf_dir):
    return _verdicts(spark, sf_dir, "customers", "stream")


@query
def dq_orders_stream(spark, sf_dir):
    return _verdicts(spark, sf_dir, "orders", "stream")


@query
def dq_payments_stream(spark, sf_dir):
    return _verdicts(spark, sf_dir, "payments", "stream")


@query
def dq_declared(spark, sf_dir):
    return _union(
        [
            df.groupBy("validation_status", "validation_reason")
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(t).alias("source_table"), "validation_status", "validation_reason", "row_count")
            for t, df in _judged(spark, sf_dir, "declared").items()
        ]
    )


@query
def dq_score(spark, sf_dir):
    return quality.quality_score(_judged(spark, sf_dir))


@query
def dq_fork(spark, sf_dir):
    """Accepted and rejected rows per table; together they are all rows."""
    return _union(
        [
            part.agg(F.count("*").alias("row_count")).select(
                F.lit(t).alias("source_table"), F.lit(side).alias("side"), "row_count"
            )
            for t, df in _judged(spark, sf_dir).items()
            for side, part in (("silver", rules.valid_rows(df)), ("errors", rules.invalid_rows(df)))
        ]
    )


@query
def dead_letter_records(spark, sf_dir):
    return _all_errors(spark, sf_dir).select(
        "source_table",
        "record_id",
        "processing_timestamp",
        "pipeline_run_id",
        "validation_status",
        "validation_reason",
    )


@query
def dq_unique_email(spark, sf_dir):
    return integrity.duplicate_values(wh.customers(spark, sf_dir, poison=True), "email")


@query
def dq_constraints(spark, sf_dir):
    tables = {**_entities(spark, sf_dir), "order_items": wh.order_items(spark, sf_dir, True)}
    return _union([integrity.constraint_violations(df, t) for t, df in tables.items()])


@query
def dq_orphans(spark, sf_dir):
    needed: dict[str, set[str]] = {}
    for child, column, parent, key in FOREIGN_KEYS:
        needed.setdefault(child, set()).add(column)
        needed.setdefault(parent, set()).add(key)
    tables = {
        name: getattr(wh, name)(spark, sf_dir, True, sorted(columns))
        for name, columns in needed.items()
    }
    return integrity.orphan_report(tables, FOREIGN_KEYS)


@query
def tier_audit(spark, sf_dir):
    """Rows per tier of a lake filled from the order table."""
    base = scratch_dir(spark, "audit")
    messages = wh.order_messages(_raw(spark, sf_dir, "orders"))
    landed = messages.withColumn("landed_at", F.current_timestamp())
    sinks.write_table(landed, f"{base}/bronze/orders")
    sinks.export_table(wh.orders(spark, sf_dir, poison=True), f"{base}/batch", "orders")
    ingest.ingest_table(spark, f"{base}/batch", base, "orders", profile="record")
    marts.build_daily_sales(spark.read.parquet(f"{base}/silver/orders"), f"{base}/gold")
    return ingest.audit_lake(spark, base).select("tier", "is_active", "row_count")


# --- change log ------------------------------------------------------------------------


def _messages(spark, sf_dir):
    return wh.order_messages(_raw(spark, sf_dir, "orders"))


def _events(spark, sf_dir, profile="record"):
    return envelope.read_events(_messages(spark, sf_dir), ORDERS, profile)


_EVENT = ["operation", "event_ts_ms", "log_position", *ORDERS.columns]


@query
def cdc_parse(spark, sf_dir):
    parsed = envelope.parse_envelopes(_messages(spark, sf_dir), ORDERS)
    return envelope.flatten(parsed, ORDERS).select(*_EVENT, "is_empty", "is_corrupt")


@query
def cdc_active_image(spark, sf_dir):
    parsed = envelope.parse_envelopes(_messages(spark, sf_dir), ORDERS)
    return parsed.select(
        "operation",
        "log_position",
        F.col("before.order_status").alias("status_before"),
        F.col("after.order_status").alias("status_after"),
        F.col("data.order_status").alias("status_active"),
    )


@query
def cdc_event_dedup(spark, sf_dir):
    return distinct_events(_events(spark, sf_dir), "order_id").select(*_EVENT)


@query
def cdc_envelope_validation(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "operation", "log_position", "order_id", "validation_status", "validation_reason"
    )


@query
def cdc_split(spark, sf_dir):
    """Both sides of the fork of the distinct events, with their reasons."""
    accepted, rejected = pipelines.split_events(_messages(spark, sf_dir), ORDERS)
    sides = [
        accepted.select(F.lit("silver").alias("side"), "validation_reason"),
        rejected.select(F.lit("errors").alias("side"), "validation_reason"),
    ]
    return _union(sides).groupBy("side", "validation_reason").agg(F.count("*").alias("event_count"))


@query
def cdc_idempotent_union(spark, sf_dir):
    events = _events(spark, sf_dir)
    first = distinct_events(events.filter(F.col("operation") == "c"), "order_id")
    return merge_batches(first, events, "order_id").select(*_EVENT)


@query
def cdc_latest_state(spark, sf_dir):
    return ingest.snapshot_of_messages(_messages(spark, sf_dir), ORDERS)


@query
def cdc_advance_state(spark, sf_dir):
    """Updates and deletes folded into the state of the creations."""
    accepted, _ = pipelines.split_events(_messages(spark, sf_dir), ORDERS)
    accepted = staged(state.change_columns(accepted, ORDERS), "accepted")  # parsed once
    created = state.latest_changes(accepted.filter(F.col("operation") == "c"), ORDERS)
    later = accepted.filter(F.col("operation") != "c")
    return state.live_rows(state.advance_state(created, later, ORDERS), ORDERS)


@query
def cdc_change_audit(spark, sf_dir):
    return state.change_audit(envelope.parse_envelopes(_messages(spark, sf_dir), ORDERS), ORDERS)


@query
def status_transitions(spark, sf_dir):
    """Every status an order went through, and how long each had lasted."""
    accepted, _ = pipelines.split_events(_messages(spark, sf_dir), ORDERS)
    return transitions_of(accepted, "order_id", "order_status", events_per_range=5_000)


@query
def event_transitions(spark, sf_dir):
    """What users did next, over all events; few users have many events each."""
    events = wh.events(spark, sf_dir).select(
        F.col("user_id").cast("long"),
        F.lit("u").alias("operation"),
        F.col("event_ms").alias("event_ts_ms"),
        F.col("event_id").cast("long").alias("log_position"),
        "event_type",
    )
    return transitions_of(events, "user_id", "event_type", events_per_range=1_000)


@query
def lineage_columns(spark, sf_dir):
    accepted, _ = pipelines.split_events(_messages(spark, sf_dir), ORDERS)
    stamp = F.lit(_STAMP).cast("timestamp")
    return envelope.with_lineage(accepted, "orders", "lineage", stamp).select(
        "order_id",
        "operation",
        "source_table",
        "event_timestamp",
        "processing_timestamp",
        "pipeline_run_id",
    )


@query
def errors_raw_poison(spark, sf_dir):
    """Dead letters of the change log; unreadable messages show their raw text."""
    _, rejected = pipelines.split_events(_messages(spark, sf_dir), ORDERS)
    unreadable = F.col("validation_reason") == "unparseable envelope"
    return rejected.select(
        "source_table",
        "record_id",
        "operation",
        "validation_reason",
        F.when(unreadable, F.col("raw_payload")).alias("unreadable_text"),
        F.col("raw_payload").isNotNull().alias("has_payload"),
    )


@query
def cdc_snapshot_dedup(spark, sf_dir):
    items = wh.order_items(spark, sf_dir)
    # Item keys repeat with other values; the latest shipment wins, then the greatest row.
    return snapshot(items, "order_item_id", [F.col("shipped_at")]).select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price"
    )


# --- keyed writes ----------------------------------------------------------------------


def _open_and_filled(spark, sf_dir):
    """The order snapshot before the orders in state ``O`` arrived, and all orders."""
    all_orders = _raw(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("order_id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        F.lit("PLACED").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("warehouse_status"),
    )
    return all_orders.filter(F.col("warehouse_status") != "O"), all_orders


@query
def upsert_status(spark, sf_dir):
    target, all_orders = _open_and_filled(spark, sf_dir)
    updates = all_orders.filter(F.col("warehouse_status") != "P").withColumns(
        {"order_status": F.lit("DELIVERED"), "total_amount": F.col("total_amount") * 2}
    )
    return merge.upsert(target, updates, "order_id", merge.UPSERT_COLUMNS["orders"])


@query
def insert_if_absent(spark, sf_dir):
    target, all_orders = _open_and_filled(spark, sf_dir)
    rows = all_orders.withColumn("order_status", F.lit("CONFIRMED"))
    return merge.insert_if_absent(target, rows, "order_id")


def _merged(spark, sf_dir, table, rows, old, new):
    """A third of the keys missing from the table; every second key updated, twice; then
    all rows offered once more, of which only unknown keys are taken."""
    base, entity = scratch_dir(spark, "keyed"), ENTITIES[table]
    key, (column,) = F.col(entity.key), merge.UPSERT_COLUMNS[table]
    rows = rows.withColumn(column, old) if old is not None else rows
    writes.insert_rows(spark, base, entity, rows.filter(key % 3 != 0))
    updates = rows.filter(key % 2 == 0).withColumn(column, new)
    writes.upsert_rows(spark, base, entity, updates)
    writes.upsert_rows(spark, base, entity, updates)
    writes.insert_rows(spark, base, entity, rows)
    return writes.lake_table(spark, base, entity).read()


@query
def merge_orders(spark, sf_dir):
    rows = wh.orders(spark, sf_dir).drop("order_date")
    return _merged(spark, sf_dir, "orders", rows, None, F.lit("SHIPPED"))


@query
def merge_customers(spark, sf_dir):
    rows, new = wh.customers(spark, sf_dir), F.lit("2024-02-01T00:00:00")
    rows = rows.select("customer_id", "first_name", "last_name", "email", "city", "state")
    return _merged(spark, sf_dir, "customers", rows, F.lit("2024-01-01T00:00:00"), new)


@query
def merge_products(spark, sf_dir):
    rows = wh.products(spark, sf_dir)
    rows = rows.select("product_id", "product_name", "category", "price", "stock_quantity")
    return _merged(spark, sf_dir, "products", rows, None, F.col("price") + 1)


@query
def merge_payments(spark, sf_dir):
    rows = wh.payments(spark, sf_dir).drop("payment_date")
    return _merged(spark, sf_dir, "payments", rows, None, F.lit("REFUNDED"))


# --- marts that follow the changes -----------------------------------------------------

_FIGURES = {
    "daily_sales": ("order_date_dt", "order_status", "total_orders", "total_revenue", "avg_order_value"),
    "customer_lifetime_value": (
        "customer_id", "email", "lifetime_orders", "lifetime_value", "average_basket_size",
    ),
    "product_performance": ("product_id", "product_name", "total_units_sold", "gross_revenue", None),
    "payment_summary": (
        "payment_method", "payment_status", "transaction_count", "total_amount", "avg_payment_amount",
    ),
}


def _figures(df, mart):
    """The rows of any mart in one shape: two names, a count, a total, a mean, two dates."""
    first, second, count, total, mean = _FIGURES[mart]

    def date(name):
        found = F.col(name) if name in df.columns else F.lit(None)
        return found.cast("date").alias(name.replace("_order_date", "_date"))

    return df.select(
        F.lit(mart).alias("mart"),
        F.col(first).cast("string").alias("first_key"),
        F.col(second).cast("string").alias("second_key"),
        F.col(count).cast("long").alias("units"),
        F.col(total).alias("amount"),
        (F.col(mean) if mean else F.lit(None).cast("double")).alias("mean"),
        date("first_order_date"),
        date("latest_order_date"),
    )


@query
def marts_after_changes(spark, sf_dir):
    """All marts after order changes in four shuffled parts, line items in two and payments
    before and after an update, each adding only what it changes; folded half way."""
    base = scratch_dir(spark, "deltas")
    gold = f"{base}/gold"
    judged = staged(pipelines.distinct_judged(_messages(spark, sf_dir), ORDERS, "record"), "judged")
    accepted = pipelines.changelog_rows(judged, ORDERS, "adhoc")
    rejected = dead_letters(judged, ORDERS, "adhoc", F.col("processing_time"))
    part = F.pmod(F.xxhash64("order_id", "event_ts_ms", "operation"), F.lit(4))
    accepted = staged(accepted.withColumn("part", part), "accepted")
    states = {name: fork.state_table(spark, base, name) for name in ("orders", "order_items", "payments")}
    dead = staged(rejected, "rejected")
    for number in (2, 0, 3, 1):
        events = accepted.filter(F.col("part") == number)
        merged = fork.advance(states["orders"], events, dead, ORDERS)
        deltas.advance_marts(spark, gold, f"orders-{number}", {"orders": merged.changes})
        if number == 0:
            deltas.fold(spark, gold, "daily_sales")
            deltas.fold(spark, gold, "customer_lifetime_value")
    items = wh.order_items(spark, sf_dir)
    for late in (True, False):
        half = items.filter((F.col("product_id") % 2 == 1) == late)
        merged = states["order_items"].advance(
            half,
            lambda r: [r[n] for n in ("shipped_at", "order_id", "product_id", "quantity", "unit_price")],
        )
        deltas.advance_marts(spark, gold, f"items-{late}", {"order_items": merged.changes})
    payments = wh.payments(spark, sf_dir)
    updated = payments.filter(F.col("payment_id") % 5 == 0).withColumn("payment_status", F.lit("REFUNDED"))
    for name, rows in (("first", payments), ("second", updated)):
        merged = states["payments"].upsert(rows, merge.UPSERT_COLUMNS["payments"])
        for _ in range(2):  # a repeated run replaces itself
            deltas.advance_marts(spark, gold, name, {"payments": merged.changes})
    dimensions = {"customers": wh.customers(spark, sf_dir), "products": wh.products(spark, sf_dir)}
    return _union(
        [_figures(deltas.current_mart(spark, gold, mart, dimensions), mart) for mart in deltas.MARTS]
    )


# --- batch files -----------------------------------------------------------------------


@query
def ingest_metrics(spark, sf_dir):
    """Rows per silver table after loading CSV and Parquet files; payments have no file."""
    base = scratch_dir(spark, "ingest")
    frames = _entities(spark, sf_dir)
    frames["order_items"] = wh.order_items(spark, sf_dir).drop("shipped_at")
    for name in ("customers", "products"):
        frames[name].write.options(
            header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(f"{base}/batch/{name}.csv")
    for name in ("orders", "order_items"):
        frames[name].write.parquet(f"{base}/batch/{name}.parquet")
    metrics = ingest.run_batch_ingestion(spark, f"{base}/batch", base)
    return spark.createDataFrame(list(metrics.items()), "source_table string, row_count long")


@query
def batch_quality(spark, sf_dir):
    """Scores of the batch job over files with planted defects: of all that came in."""
    base = scratch_dir(spark, "batch")
    frames = {**_entities(spark, sf_dir), "order_items": wh.order_items(spark, sf_dir).drop("shipped_at")}
    for name, df in frames.items():
        df.write.parquet(f"{base}/batch/{name}.parquet")
    result = ingest.run_batch(spark, f"{base}/batch", base, gate=False)
    return spark.createDataFrame(
        result["quality"],
        "source_table string, total_count long, valid_count long, invalid_count long, "
        "dq_score double, below_sla boolean, error_alert boolean",
    ).filter("source_table <> 'order_items'")


@query
def csv_roundtrip(spark, sf_dir):
    paths = sinks.export_table(
        wh.customers(spark, sf_dir, poison=True), scratch_dir(spark, "csv"), "customers"
    )
    return inputs.read_csv(spark, paths["csv"], ENTITIES["customers"].payload)


@query
def lake_views(spark, sf_dir):
    """SQL over the registered views: silver snapshot, batch Parquet, batch CSV and the
    dead-letter table side by side."""
    base = scratch_dir(spark, "views")
    sinks.write_table(wh.orders(spark, sf_dir), f"{base}/silver/orders", ORDERS.partition_by)
    sinks.export_table(wh.payments(spark, sf_dir), f"{base}/batch", "payments")
    csv = wh.products(spark, sf_dir).write.option("header", "true")
    csv.csv(f"{base}/batch/products.csv")
    sinks.append_incidents(_all_errors(spark, sf_dir), base)
    inputs.register_views(spark, base)
    return spark.sql(
        """
        SELECT 'orders' AS view_name, count(*) AS row_count,
            cast(sum(cast(total_amount AS decimal(38,2))) AS double) AS amount FROM orders_source
        UNION ALL SELECT 'payments', count(*),
            cast(sum(cast(payment_amount AS decimal(38,2))) AS double) FROM payments_source
        UNION ALL SELECT 'products', count(*),
            cast(sum(cast(price AS decimal(38,2))) AS double) FROM products_source
        UNION ALL SELECT 'errors', count(*), NULL FROM errors_source
        """
    )


@query
def replayed_bronze(spark, sf_dir):
    """The events on both sides after landed messages were replayed."""
    base = scratch_dir(spark, "replay")
    sinks.write_table(_messages(spark, sf_dir), f"{base}/bronze/orders")
    ingest.replay(spark, f"{base}/bronze/orders", "orders", base)
    shown = ["operation", "validation_status", "validation_reason", "source_table"]
    accepted = spark.read.parquet(f"{base}/silver_changelog/orders")
    rejected = spark.read.parquet(f"{base}/errors/orders")
    return _union(
        [
            accepted.select(F.col("order_id").cast("string").alias("record_id"), "total_amount", *shown),
            rejected.select("record_id", F.lit(None).cast("double").alias("total_amount"), *shown),
        ]
    )


@query
def compact_partition(spark, sf_dir):
    """The order table after one of its partitions was compacted."""
    path = scratch_dir(spark, "compact")
    wh.orders(spark, sf_dir).repartition(8).write.partitionBy("order_status").parquet(path)
    upkeep.compact_partition(spark, path, ["order_status"], order_status="DELIVERED")
    return spark.read.parquet(path).select("order_id", "order_status", "total_amount")


def _event_days(spark, sf_dir):
    return _raw(spark, sf_dir, "events").select(
        "event_id", F.col("value"), F.to_date("ts").alias("event_day")
    )


BACKFILLED_DAY = "2024-01-15"


@query
def backfill_day(spark, sf_dir):
    """A day-partitioned table after one day was recomputed with doubled values."""
    path = scratch_dir(spark, "backfill")
    days = _event_days(spark, sf_dir)
    sinks.write_table(days, path, ["event_day"])
    corrected = days.withColumn("value", F.col("value") * 2)
    upkeep.backfill_day(corrected, path, "event_day", BACKFILLED_DAY)
    return spark.read.parquet(path).select("event_id", "value", "event_day")


@query
def schema_merge(spark, sf_dir):
    """Files from before and after a column was added, read as one table."""
    path = scratch_dir(spark, "merge")
    orders = wh.orders(spark, sf_dir).select("order_id", "order_date", "order_status")
    added = F.lit("1998-01-01").cast("date")
    old = orders.filter(to_day("order_date") < added).drop("order_status")
    new = orders.filter(to_day("order_date") >= added)
    old.write.parquet(f"{path}/batch=1")
    new.write.parquet(f"{path}/batch=2")
    return inputs.read_parquet(spark, path, merge_schema=True).select("order_id", "order_status")


@query
def skew_salted_join(spark, sf_dir):
    """Orders with the size of their status, joined on a key of few, hot values."""
    orders = wh.orders(spark, sf_dir).select("order_id", "order_status", "total_amount")
    sizes = reports.status_aggregate(orders).select("order_status", "order_count")
    return skew.salted_join(orders, sizes, "order_status", "left")


# --- streams ---------------------------------------------------------------------------

_NOW = {"availableNow": True}
_ROWS_PER_FILE = 100_000
_ROWS_PER_STATE = 1_000_000


def _cores(spark):
    return spark.sparkContext.defaultParallelism


def _finish(spark, queries):
    pipelines.await_all(spark, queries)


def _row_count(spark, sf_dir, table):
    """From the footers of the table's files."""
    return _raw(spark, sf_dir, table).count()


def _files_a_batch(spark, rows):
    """Over how many files the messages of about ``rows`` rows are spread: with more rows more
    files of the same size; small batches have one for every core, tiny ones one."""
    return max(1, min(_cores(spark), rows // 2_000), -(-rows // _ROWS_PER_FILE))


def _states(spark, rows):
    """Partitions of a state with about ``rows`` keys: as many as keep them of one size."""
    return max(_cores(spark), -(-rows // _ROWS_PER_STATE))


def _whole_waves(spark, tasks):
    """So many tasks that, if they are more than the cores, no core is idle while a few last
    ones run."""
    cores = _cores(spark)
    return tasks if tasks <= cores else -(-tasks // cores) * cores


def _in_batches(spark, messages, base, table, rows, batches=7):
    """Messages of about ``rows`` rows landed in shuffled order and read in so many
    micro-batches, each of several files."""
    path = f"{base}/bronze/{table}"
    files = _files_a_batch(spark, rows // batches)
    landed = messages.withColumn("landed_at", F.current_timestamp())
    landed.repartition(files * batches).write.parquet(path)
    return landed_messages(spark, path, max_files_per_trigger=files)


def _orders_silver(spark, messages, base, rows):
    _finish(
        spark,
        pipelines.process_orders_stream(
            spark,
            messages,
            base,
            f"{base}/checkpoints",
            profile="stream",
            trigger=_NOW,
            state_partitions=_states(spark, rows),
        ),
    )
    return spark.read.parquet(f"{base}/silver_changelog/orders").select(
        *ORDERS.columns,
        "order_date_dt",
        "operation",
        "event_ts_ms",
        "log_position",
        "source_table",
        "event_timestamp",
        F.col("processing_timestamp").isNotNull().alias("is_stamped"),
    )


@query
def stream_orders_silver(spark, sf_dir):
    messages = wh.order_messages(_raw_stream(spark, sf_dir, "orders"))
    rows = _row_count(spark, sf_dir, "orders")
    return _orders_silver(spark, messages, scratch_dir(spark, "stream"), rows)


@query
def stream_orders_batches(spark, sf_dir):
    """The same over several micro-batches whose event times are out of order."""
    base = scratch_dir(spark, "stream")
    rows = _row_count(spark, sf_dir, "orders")
    messages = _in_batches(spark, _messages(spark, sf_dir), base, "orders", rows)
    return _orders_silver(spark, messages, base, rows)


def _streamed_once(spark, sf_dir):
    """The folder of a single-query stream over all order messages, in micro-batches."""
    base = scratch_dir(spark, "stream")
    rows = _row_count(spark, sf_dir, "orders")
    messages = _in_batches(spark, _messages(spark, sf_dir), base, "orders", rows, 3)
    once = pipelines.process_stream_once(
        spark,
        messages,
        "orders",
        base,
        f"{base}/checkpoints",
        trigger=_NOW,
        state_partitions=_states(spark, rows),
    )
    _finish(spark, [once])
    return base


@query
def stream_operations_audit(spark, sf_dir):
    """Incidents per reason in the dead letters of a single-query stream."""
    errors = inputs.read_errors(spark, _streamed_once(spark, sf_dir))
    return reports.operations_audit(errors).drop("first_seen", "last_seen")


@query
def stream_snapshot(spark, sf_dir):
    """The current rows rebuilt from a single-query stream."""
    base = _streamed_once(spark, sf_dir)
    ingest.refresh_snapshot(spark, base, "orders")
    rows = spark.read.parquet(f"{base}/silver/orders")
    times = {n: F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss") for n in ("order_date", "updated_at")}
    return rows.withColumns(times).select(*ORDERS.columns)


@query
def stream_orders_errors(spark, sf_dir):
    base = scratch_dir(spark, "stream")
    messages = wh.order_messages(_raw_stream(spark, sf_dir, "orders"))
    once = pipelines.process_stream_once(
        spark,
        messages,
        "orders",
        base,
        f"{base}/checkpoints",
        profile="stream",
        trigger=_NOW,
        state_partitions=_states(spark, _row_count(spark, sf_dir, "orders")),
    )
    _finish(spark, [once])
    return inputs.judged_errors(spark, base, "orders").select(
        "source_table", "record_id", "operation", "validation_status", "validation_reason"
    )


def _forked(spark, sf_dir, profile, before=4, after=3, **options):
    """The folder of a forked stream over all order messages in shuffled micro-batches, the
    query started anew after some of them."""
    base = scratch_dir(spark, "stream")
    number = _row_count(spark, sf_dir, "orders")
    files = _whole_waves(spark, _files_a_batch(spark, number // (before + after)))
    landed = _messages(spark, sf_dir).withColumn("landed_at", F.current_timestamp())
    landed.repartition((before + after) * files).write.parquet(f"{base}/arriving")
    arrived = spark.read.parquet(f"{base}/arriving").withColumn("file", F.input_file_name())
    early = F.regexp_extract("file", r"part-0*(\d+)", 1).cast("int") < before * files
    for part, count in ((early, before), (~early, after)):
        rows = arrived.filter(part).drop("file").repartition(count * files)
        rows.write.mode("append").parquet(f"{base}/bronze/orders")
        query = fork.process_stream_fork(
            spark,
            landed_messages(spark, f"{base}/bronze/orders", max_files_per_trigger=files),
            ORDERS,
            base,
            f"{base}/checkpoints",
            profile=profile,
            trigger=_NOW,
            state_partitions=_whole_waves(spark, _states(spark, number)),
            **options,
        )
        _finish(spark, [query])
    return base


@query
def stream_fork_once(spark, sf_dir):
    """Both sides of the one query that writes two tables."""
    return _both_sides(spark, _forked(spark, sf_dir, "stream"))


def _both_sides(spark, base):
    accepted = spark.read.parquet(f"{base}/silver_changelog/orders")
    rejected = inputs.read_errors(spark, base)
    shown = ("source_table", "record_id", "operation", "validation_status", "validation_reason")
    return _union(
        [
            accepted.withColumn("record_id", F.col("order_id").cast("string")).select(
                *shown, "log_position", "total_amount", "order_date_dt"
            ),
            rejected.select(
                *shown,
                F.lit(None).cast("long").alias("log_position"),
                F.lit(None).cast("double").alias("total_amount"),
                F.lit(None).cast("date").alias("order_date_dt"),
            ),
        ]
    )


@query
def stream_dedup_far_copies(spark, sf_dir):
    """All messages streamed, and then all of them once more by another query without the
    first one's state: every event is stored once."""
    base = _forked(spark, sf_dir, "stream", 2, 1, exact=True)
    again = fork.process_stream_fork(
        spark,
        landed_messages(spark, f"{base}/bronze/orders"),
        ORDERS,
        base,
        f"{base}/replay",
        profile="stream",
        trigger=_NOW,
        state_partitions=_states(spark, _row_count(spark, sf_dir, "orders")),
        exact=True,
    )
    _finish(spark, [again])
    return _both_sides(spark, base)


@query
def stream_latest_state(spark, sf_dir):
    """The current rows that the stream itself keeps."""
    return fork.latest_rows(spark, _forked(spark, sf_dir, "record", keep_state=True), ORDERS)


@query
def stream_compacted(spark, sf_dir):
    """The accepted changes of a forked stream whose closed micro-batches were put together
    and removed."""
    base = _forked(spark, sf_dir, "stream", 3, 1)
    upkeep.compact_batches(spark, base, ORDERS)
    upkeep.remove_compacted(spark, base, ORDERS)
    return inputs.read_changes(spark, base, ORDERS).select(
        *ORDERS.columns, "order_date_dt", "operation", "event_ts_ms", "log_position", "source_table"
    )


@query
def stream_late_events(spark, sf_dir):
    """Late events of a forked stream, audited after its first three micro-batches and again
    after the two that follow; the second audit reads those two."""
    base = scratch_dir(spark, "stream")
    rows = _row_count(spark, sf_dir, "orders")
    files = _files_a_batch(spark, rows // 5)
    sent = _messages(spark, sf_dir).withColumn("number", (F.col("key").cast("long") - 1) % 5)
    sent.write.partitionBy("number").parquet(f"{base}/sent")
    for batches in ((0, 1, 2), (3, 4)):
        for batch in batches:  # the source takes files in the order they came
            part = spark.read.parquet(f"{base}/sent/number={batch}")
            landed = part.withColumn("landed_at", F.current_timestamp())
            landed.repartition(files).write.mode("append").parquet(f"{base}/bronze/orders")
        query = fork.process_stream_fork(
            spark,
            landed_messages(spark, f"{base}/bronze/orders", max_files_per_trigger=files),
            ORDERS,
            base,
            f"{base}/checkpoints",
            trigger=_NOW,
            state_partitions=_states(spark, rows),
        )
        _finish(spark, [query])
        ingest.advance_late_events(spark, base, ORDERS)
    late = spark.read.parquet(f"{base}/late_events_by_batch/orders")
    return late.select("record_id", "operation", "event_ts_ms", "watermark_ms")


_SOURCES = {
    "customers": "customer", "products": "part", "payments": "orders", "order_items": "lineitem",
}


def _streamed(spark, sf_dir, table, date_column, columns, batches=1):
    """Bronze landing of one table, then its pipeline; accepted rows with their payload and
    rejected rows."""
    entity = ENTITIES[table]
    base = scratch_dir(spark, "stream")
    rows = getattr(wh, table)(spark, sf_dir, poison=True).select(*columns)
    messages = wh.entity_messages(rows, table, entity.key, date_column)
    number = _row_count(spark, sf_dir, _SOURCES[table])
    _finish(
        spark,
        pipelines.process_stream(
            spark,
            _in_batches(spark, messages, base, table, number, batches),
            entity,
            base,
            f"{base}/checkpoints",
            profile="stream",
            trigger=_NOW,
            state_partitions=_states(spark, number),
        ),
    )
    accepted = spark.read.parquet(f"{base}/silver_changelog/{table}")
    payload = [name for name in columns if name != entity.key]
    types = dict(accepted.dtypes)
    rejected = inputs.read_errors(spark, base)
    return _union(
        [
            accepted.select(
                F.col(entity.key).cast("string").alias("record_id"),
                "validation_status",
                "validation_reason",
                *payload,
            ),
            rejected.select(
                "record_id",
                "validation_status",
                "validation_reason",
                *[F.lit(None).cast(types[name]).alias(name) for name in payload],
            ),
        ]
    )


@query
def stream_customers(spark, sf_dir):
    columns = ["customer_id", "first_name", "last_name", "email", "city", "state"]
    return _streamed(spark, sf_dir, "customers", None, columns)


@query
def stream_payments(spark, sf_dir):
    columns = ENTITIES["payments"].columns
    return _streamed(spark, sf_dir, "payments", "payment_date", columns)


@query
def stream_payments_batches(spark, sf_dir):
    columns = ENTITIES["payments"].columns
    return _streamed(spark, sf_dir, "payments", "payment_date", columns, batches=7)


@query
def stream_products(spark, sf_dir):
    columns = ["product_id", "product_name", "category", "price", "stock_quantity"]
    return _streamed(spark, sf_dir, "products", None, columns)


@query
def stream_order_items(spark, sf_dir):
    # Item keys repeat with other values, of which the stream keeps the first to arrive.
    columns = ENTITIES["order_items"].columns
    found = _streamed(spark, sf_dir, "order_items", None, columns)
    return found.select("record_id", "validation_status", "validation_reason")


def _twice(events):
    copies = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return copies.select(
        "event_id",
        F.col("event_type").alias("operation"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ts_ms"),
    )


@query
def stream_event_dedup(spark, sf_dir):
    """Every event sent twice; the stream keeps one of each."""
    base = scratch_dir(spark, "stream")
    rows = _row_count(spark, sf_dir, "events")
    return _one_of_each(spark, _twice(_raw_stream(spark, sf_dir, "events")), base, rows)


@query
def stream_event_dedup_batches(spark, sf_dir):
    """The same with the copies in different micro-batches, out of order."""
    base = scratch_dir(spark, "stream")
    sent = _twice(_raw(spark, sf_dir, "events"))
    rows = _row_count(spark, sf_dir, "events")
    files = _files_a_batch(spark, 2 * rows // 5)
    sent.repartition(5 * files).write.parquet(f"{base}/sent")
    reader = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", files)
    return _one_of_each(spark, reader.parquet(f"{base}/sent"), base, rows)


def _one_of_each(spark, twice, base, rows):
    stored = pipelines.start_table(
        distinct_events_stream(twice, "event_id"),
        f"{base}/events",
        f"{base}/state",
        None,
        (),
        _NOW,
        _states(spark, rows),
    )
    _finish(spark, [stored])
    return spark.read.parquet(f"{base}/events")


@query
def late_event_audit(spark, sf_dir):
    late = lateness.late_events(wh.events(spark, sf_dir), "event_ms", "arrival_ms")
    return late.select("event_id", "event_ms", "arrival_ms", "watermark_ms")


@query
def freshness(spark, sf_dir):
    return lateness.freshness(wh.events(spark, sf_dir), "event_ms", "arrival_ms", ["event_type"])


@query
def freshness_percentiles(spark, sf_dir):
    """Lag percentiles per event type, merged from sketches by hour; and whether each is
    within the stated error of its rank among all lags."""
    events = wh.events(spark, sf_dir)
    hours = events.withColumn("hour", F.floor(F.col("arrival_ms") / 3_600_000))
    sketches = lateness.lag_sketches(hours, "event_ms", "arrival_ms", ["event_type", "hour"])
    found = staged(lateness.freshness_percentiles(sketches, ["event_type"]), "percentiles")
    lag = (F.col("arrival_ms") - F.col("event_ms")).alias("lag")
    placed = events.select("event_type", lag).join(F.broadcast(found), "event_type")  # 3 a type
    keys = ("event_type", "percentile", "event_count", "max_lag_ms", "sla_breaches")
    low, high = F.count_if(F.col("lag") < F.col("lag_ms")), F.count_if(F.col("lag") <= F.col("lag_ms"))
    wanted, error = F.col("percentile"), F.lit(lateness.RANK_ERROR)
    ranks = placed.groupBy(*keys).agg((low / F.count("*")).alias("low"), (high / F.count("*")).alias("high"))
    within = (F.col("low") <= wanted + error) & (F.col("high") >= wanted - error)
    return ranks.select(*keys, within.alias("within_error"))


@query
def dq_across_loads(spark, sf_dir):
    """What shows only when a load is compared with what is stored: e-mail addresses given
    twice, and orders of customers that neither has."""
    key = F.col("customer_id")
    customers = wh.customers(spark, sf_dir, poison=True)
    stored = customers.filter(key % 3 == 0)
    new = customers.filter(key.isNull() | (key % 3 == 1))
    mails = integrity.duplicates_with_stored(stored, new, "email")
    orders = wh.orders(spark, sf_dir, poison=True).filter(F.col("order_id") % 2 == 0)
    orphans = integrity.orphans_with_stored(orders, "customer_id", stored, "customer_id", new)
    return _union(
        [
            mails.select(F.lit("email").alias("check"), F.col("email").alias("value"), "stored_rows", "new_rows"),
            orphans.select(
                F.lit("customer_id").alias("check"),
                F.col("foreign_key").cast("string").alias("value"),
                F.lit(0).cast("long").alias("stored_rows"),
                F.col("row_count").alias("new_rows"),
            ),
        ]
    )


@query
def events_json(spark, sf_dir):
    props = F.from_json("props", "k INT")
    return (
        _raw(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.count("*").alias("event_count"), F.sum(props["k"]).alias("k_total"))
    )
