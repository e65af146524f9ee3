"""Headline queries, timed warm. Prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. A lake
is written once from the tables, as the batch job would; then each query runs
``BENCH_RUNS`` times after the warm-up rounds, and its median is reported. ``value`` is the sum.
Beside it: layouts compared on the orders ``BENCH_COPIES`` times over, where reading dominates,
and the events per second of a stream over several micro-batches.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.temporal import month_key, to_day  # noqa: E402
from tidemark.operators.deadletter import dead_letters  # noqa: E402
from tidemark.operators.dedup import distinct_events, snapshot  # noqa: E402
from tidemark.operators.envelope import read_events  # noqa: E402
from tidemark.operators.rules import validate  # noqa: E402
from tidemark.plans import ingest, marts, reports  # noqa: E402
from tidemark.plans.registry import PRUNED_DAY  # noqa: E402
from tidemark.schemas import ENTITIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sinks import tables as sinks  # noqa: E402
from tidemark.sinks import upkeep  # noqa: E402
from tidemark.sources import tables as inputs  # noqa: E402
from tidemark.sources import warehouse as wh  # noqa: E402
from tidemark.sources.streams import landed_messages  # noqa: E402
from tidemark.streaming import fork, pipelines  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARMUPS = int(os.environ.get("BENCH_WARMUPS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "40"))


def session(scratch: str):
    # Small local data: few shuffle partitions, no console noise.
    return build_session(
        "tidemark-bench",
        extra={
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": scratch,
        },
        streaming=True,
    )


def write_lake(spark, base: str) -> dict[str, float]:
    """Silver tables, dead letters, and the layouts the format experiments compare."""
    timings = {}
    orders = wh.orders(spark, SF_DIR)
    day = to_day("order_date")
    frames = {
        "customers": wh.customers(spark, SF_DIR),
        "products": wh.products(spark, SF_DIR),
        "orders": orders.withColumns({"order_date_dt": day, "order_month": month_key(day)}),
        "order_items": wh.order_items(spark, SF_DIR),
        "payments": wh.payments(spark, SF_DIR),
    }
    for name, df in frames.items():
        sinks.write_table(df, f"{base}/silver/{name}", ENTITIES[name].partition_by)
    sinks.write_table(frames["orders"], f"{base}/by_month", ["order_month"])
    start = time.perf_counter()
    orders.write.option("header", "true").csv(f"{base}/orders.csv")
    timings["write_csv"] = time.perf_counter() - start
    start = time.perf_counter()
    frames["orders"].write.parquet(f"{base}/orders.parquet")
    timings["write_parquet"] = time.perf_counter() - start
    errors = [
        dead_letters(validate(getattr(wh, t)(spark, SF_DIR, True), t), ENTITIES[t], "bench")
        for t in ("customers", "products", "orders", "payments")
    ]
    for df in errors:
        sinks.append_incidents(df, base)
    messages = wh.order_messages(spark.read.parquet(f"{SF_DIR}/orders.parquet"))
    messages.repartition(int(CPUS)).write.parquet(f"{base}/bronze/orders")
    return timings


def headline(spark, base: str) -> dict:
    silver = inputs.load_silver(spark, f"{base}/silver")
    customers, products = silver["customers"], silver["products"]
    orders, items, payments = silver["orders"], silver["order_items"], silver["payments"]
    plain = spark.read.parquet(f"{base}/orders.parquet")
    as_csv = inputs.read_csv(spark, f"{base}/orders.csv", ENTITIES["orders"].payload)
    one_month = inputs.read_partition(spark, f"{base}/by_month", order_month=PRUNED_DAY[:7])
    errors = inputs.read_errors(spark, base)
    messages = spark.read.parquet(f"{base}/bronze/orders")
    order_entity = ENTITIES["orders"]
    return {
        "daily_sales": lambda: reports.daily_sales(orders),
        "customer_lifetime_value": lambda: reports.customer_lifetime_value(customers, orders),
        "product_performance": lambda: reports.product_performance(products, items),
        "payment_summary": lambda: reports.payment_summary(payments),
        "operations_audit": lambda: reports.operations_audit(errors),
        "status_aggregate_csv": lambda: reports.status_aggregate(as_csv),
        "status_aggregate_parquet": lambda: reports.status_aggregate(plain),
        "day_sum_plain": lambda: reports.day_total(plain, PRUNED_DAY),
        "day_sum_pruned": lambda: reports.day_total(one_month, PRUNED_DAY),
        "city_revenue": lambda: reports.city_revenue(orders, customers),
        "mart_daily_sales": lambda: marts.daily_sales_mart(orders),
        "mart_customer_lifetime_value": lambda: marts.customer_lifetime_value_mart(
            customers, orders
        ),
        "mart_product_performance": lambda: marts.product_performance_mart(products, items),
        "mart_payment_summary": lambda: marts.payment_summary_mart(payments),
        "dq_orders": lambda: validate(orders, "orders").groupBy("validation_status").count(),
        "cdc_latest_state": lambda: ingest.snapshot_of_messages(messages, order_entity),
        "cdc_event_dedup": lambda: distinct_events(
            read_events(messages, order_entity), order_entity.key
        ),
        "cdc_snapshot_dedup": lambda: snapshot(items, "order_item_id", [F.col("shipped_at")]),
    }


def layouts(spark, base: str) -> dict[str, dict]:
    """Seconds, bytes of the files read and rows per second of each layout."""
    day = to_day("order_date")
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    orders = wh.orders(spark, SF_DIR).select("*", copies).drop("copy")
    orders = orders.withColumns({"order_date_dt": day, "order_month": month_key(day)})
    plain, months = f"{base}/many.parquet", f"{base}/many_by_month"
    clustered = f"{base}/many_clustered"
    text = sinks.export_csv(orders.drop("order_date_dt", "order_month"), base, "many")
    orders.write.parquet(plain)
    sinks.write_table(orders, months, ["order_month"])
    upkeep.write_clustered(orders, clustered, ["order_date_dt", "customer_id"])
    month = PRUNED_DAY[:7]
    rows = spark.read.parquet(plain).count()
    pairs = {
        "status_csv": (
            text,
            lambda: reports.status_aggregate(
                inputs.read_csv(spark, text, ENTITIES["orders"].payload)
            ),
        ),
        "status_parquet": (plain, lambda: reports.status_aggregate(spark.read.parquet(plain))),
        "day_plain": (plain, lambda: reports.day_total(spark.read.parquet(plain), PRUNED_DAY)),
        "day_clustered": (
            clustered,
            lambda: reports.day_total(spark.read.parquet(clustered), PRUNED_DAY),
        ),
        "day_pruned": (
            f"{months}/order_month={month}",
            lambda: reports.day_total(
                inputs.read_partition(spark, months, order_month=month), PRUNED_DAY
            ),
        ),
    }
    found = {}
    for name, (path, build) in pairs.items():
        seconds = statistics.median([timed(build) for _ in range(3)])
        found[name] = {
            "seconds": round(seconds, 4),
            "file_bytes": sinks.stored_bytes(spark, path),
            "rows_per_second": round(rows / seconds),
        }
    found["day_clustered"]["bytes_of_files_with_the_day"] = bytes_with_day(spark, clustered)
    return found


def bytes_with_day(spark, path: str) -> int:
    """Size of the files whose statistics do not rule the day out."""
    name = F.regexp_extract("path", "([^/]+)$", 1).alias("name")
    sizes = spark.read.format("binaryFile").load(path).select(name, "length")
    ranges = spark.read.parquet(path).groupBy(
        F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("name")
    ).agg(F.min("order_date_dt").alias("low"), F.max("order_date_dt").alias("high"))
    wanted = F.lit(PRUNED_DAY).cast("date").between(F.col("low"), F.col("high"))
    held = ranges.filter(wanted).join(sizes, "name")
    return held.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def stream_rate(spark, base: str, files: int = 6) -> dict:
    """A stream over order messages in shuffled files, one per micro-batch: events a second
    of a query for each side, and of one query that feeds both."""
    messages = spark.read.parquet(f"{base}/bronze/orders")
    landed = messages.withColumn("landed_at", F.current_timestamp())
    landed.repartition(files).write.parquet(f"{base}/stream/in")
    start = time.perf_counter()
    queries = pipelines.process_orders_stream(
        spark,
        landed_messages(spark, f"{base}/stream/in", 1),
        f"{base}/stream",
        f"{base}/stream/checkpoints",
        trigger={"availableNow": True},
        state_partitions=int(CPUS),
    )
    pipelines.await_all(spark, queries)
    seconds = time.perf_counter() - start
    start = time.perf_counter()
    forked = fork.process_stream_fork(
        spark,
        landed_messages(spark, f"{base}/stream/in", 1),
        "orders",
        f"{base}/forked",
        f"{base}/forked/checkpoints",
        trigger={"availableNow": True},
        state_partitions=int(CPUS),
    )
    pipelines.await_all(spark, [forked])
    one = time.perf_counter() - start
    events = messages.count()
    return {
        "events": events,
        "micro_batches": files,
        "events_per_second": round(events / seconds),
        "events_per_second_one_query": round(events / one),
    }


def timed(build) -> float:
    start = time.perf_counter()
    run(build())
    return time.perf_counter() - start


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = session(scratch)
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{scratch}/lake"
    extra = write_lake(spark, base)
    timings: dict[str, float] = {}
    builds = headline(spark, base)
    for _ in range(WARMUPS):
        for build in builds.values():
            run(build())
    for name, build in builds.items():
        timings[name] = round(statistics.median([timed(build) for _ in range(RUNS)]), 4)
    rows = {
        t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").agg(F.count("*")).first()[0]
        for t in ("orders", "lineitem")
    }
    print(
        json.dumps(
            {
                "metric": "warm median seconds, sum over headline queries",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "rows": rows,
                "write_seconds": {k: round(v, 4) for k, v in extra.items()},
                "layouts": layouts(spark, base),
                "stream": stream_rate(spark, base),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
