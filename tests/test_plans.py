"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import distinct_events, snapshot
from tidemark.operators.integrity import orphan_keys
from tidemark.plans import ingest, marts, registry, reports
from tidemark.schemas import ENTITIES
from tidemark.sources import warehouse as wh

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("+- == Initial Plan ==")[0]


PURE = [
    "daily_sales", "customer_lifetime_value", "product_performance", "payment_summary", "operations_audit",
    "city_revenue", "mart_daily_sales", "mart_customer_lifetime_value", "mart_product_performance",
    "dq_orders", "dq_orphans", "cdc_event_dedup", "cdc_latest_state", "cdc_change_audit", "upsert_status",
    "status_transitions", "freshness_percentiles", "dq_across_loads", "clustered_day_sum",
]


@pytest.mark.parametrize("name", PURE)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in text


@pytest.mark.parametrize(
    "name",
    ["daily_sales", "customer_lifetime_value", "clv_inner", "product_performance", "cdc_latest_state",
     "cdc_snapshot_dedup", "mart_customer_lifetime_value", "status_transitions"],
)
def test_no_table_goes_through_one_task(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    # A top-k merges k rows per task; nothing else may end in a single partition.
    assert "Exchange SinglePartition" not in text


def test_top_k_before_rank(spark):
    text = plan(registry.QUERIES["customer_lifetime_value"](spark, SF))
    assert text.index("Window") < text.index("TakeOrderedAndProject")


def test_orders_are_reduced_before_the_join(spark):
    text = plan(registry.QUERIES["mart_customer_lifetime_value"](spark, SF))
    join = re.search(r"(BroadcastHashJoin|SortMergeJoin) \[customer_id.*LeftOuter", text).start()
    assert "partial_count" in text[join:]


def test_line_items_are_shuffled_once(spark):
    text = final_plan(
        reports.product_performance(wh.products(spark, SF), wh.order_items(spark, SF))
    )
    assert "ReusedExchange" in text
    assert len(re.findall(r"lineitem\.parquet", text)) == 1


def test_messages_are_parsed_once(spark):
    messages = wh.order_messages(spark.read.parquet(f"{SF}/orders.parquet"))
    stored = messages.select("key", "value")
    text = plan(ingest.snapshot_of_messages(stored, ENTITIES["orders"]))
    assert len(re.findall(r"from_json\(", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_scan_reads_needed_columns_only(spark):
    text = plan(reports.status_aggregate(spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("total_amount"))))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


def test_status_filter_reaches_the_files(spark, tmp_path):
    wh.orders(spark, SF).write.parquet(f"{tmp_path}/orders")
    text = plan(reports.daily_sales(spark.read.parquet(f"{tmp_path}/orders")))
    assert "Not(EqualTo(order_status,CANCELLED))" in text
    assert "customer_id" not in re.search(r"ReadSchema: .*", text).group()


def test_settings_fix_zone_and_mode(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rows = registry.QUERIES["cdc_parse"](spark, SF)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert rows.filter("operation = 'c'").first().event_ts_ms % 86_400_000 == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shuffled_rows(node):
    """Rows written by every shuffle below an executed plan node."""
    children = node.children()
    below = [n for i in range(children.size()) for n in shuffled_rows(children.apply(i))]
    if "ShuffleExchange" in node.nodeName() or node.nodeName() == "Exchange":
        below.append(node.metrics().apply("shuffleRecordsWritten").value())
    return below


@pytest.mark.parametrize("job", ["events", "snapshot", "customers", "orphans"])
def test_hot_key_is_reduced_before_the_shuffle(spark, job):
    # A third of 120,000 rows share one key; 8 tasks may send it 8 times, not 40,000 times.
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long")
    rows = spark.range(0, 120_000, 1, 8).select(
        hot.alias("order_id"),
        hot.alias("customer_id"),
        F.lit("c").alias("operation"),
        F.lit(1).cast("long").alias("event_ts_ms"),
        F.lit("PLACED").alias("order_status"),
        F.lit(1.0).alias("total_amount"),
        F.col("id").cast("string").alias("order_date"),
    )
    jobs = {
        "events": lambda: distinct_events(rows, "order_id"),
        "snapshot": lambda: snapshot(rows, "order_id"),
        "customers": lambda: marts.spending_by_customer(rows),
        "orphans": lambda: orphan_keys(
            rows, "customer_id", spark.range(10).withColumnRenamed("id", "k"), "k"
        ),
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = jobs[job]()
        executed = df._jdf.queryExecution()
        executed.toRdd().count()
        written = shuffled_rows(executed.executedPlan())
        assert written and max(written) <= 50 * 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def read_columns(text):
    """The columns of every scan of a plan."""
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_foreign_key_check_reads_keys_only(spark):
    scans = read_columns(plan(registry.QUERIES["dq_orphans"](spark, SF)))
    assert set().union(*scans) <= {
        "o_orderkey", "o_custkey", "c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey",
        "p_partkey", "l_orderkey", "l_partkey", "l_suppkey",
    }


@pytest.mark.parametrize("name, table, most", [("late_event_audit", "events", 1), ("mart_payment_success", "orders", 1)])
def test_number_of_scans(spark, name, table, most):
    """Of the final job; the arrival batches of the audit are a table by then."""
    text = plan(registry.QUERIES[name](spark, SF))
    assert len(re.findall(rf"FileScan parquet .*{table}\.parquet", text)) <= most


def test_ranking_computes_the_mart_once(spark):
    text = plan(registry.QUERIES["mart_customer_ranking"](spark, SF))
    assert "customer.parquet" not in text and "orders.parquet" not in text
    joins = re.findall(r"Join \[[^]]*lifetime_value#[^]]*\], \[[^]]*lifetime_value#[^]]*\], (\w+)", text)
    assert joins == ["Inner"], text  # rows without a value are no part of it


def test_changes_folded_into_a_state_are_parsed_once(spark):
    from tidemark.plans.registry import QUERIES

    folded = QUERIES["cdc_advance_state"](spark, "/root/testdata/sf0.001")
    assert "from_json" not in folded._jdf.queryExecution().toString()
