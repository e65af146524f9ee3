import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lateness, merge, skew
from tidemark.operators.quality import QualityGateError
from tidemark.plans import ingest
from tidemark.sinks import tables as sinks
from tidemark.sinks import upkeep
from tidemark.sources import tables as inputs


def test_upsert(spark):
    target = spark.createDataFrame([(1, "A", 1.0), (2, "A", 2.0)], "id long, s string, x double")
    updates = spark.createDataFrame(
        [(2, "B", 9.0), (3, "C", 3.0), (2, None, 8.0), (None, "Z", 0.0)], "id long, s string, x double"
    )
    got = merge.upsert(target, updates, "id", ["s"], [F.col("x")]).collect()
    assert sorted(map(tuple, got)) == [(1, "A", 1.0), (2, "B", 2.0), (3, "C", 3.0)]
    cleared = merge.upsert(target, updates.filter("x = 8"), "id", ["s"]).filter("id = 2").first()
    assert cleared.s is None  # an update to null is an update


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "A")], "id long, s string")
    rows = spark.createDataFrame([(1, "B"), (2, "C"), (2, "D"), (None, "E")], "id long, s string")
    got = merge.insert_if_absent(target, rows, "id").collect()
    assert sorted(map(tuple, got)) == [(1, "A"), (2, "D")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(1)
    keys = [None if i % 11 == 0 else 7 if i % 3 else rng.randrange(50) for i in range(4000)]
    large = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50, 2)] + [(7, "hot")], "k long, v string")
    plain = large.join(small, "k", how)
    salted = skew.salted_join(large, small, "k", how, rows_per_salt=100, share=0.1)
    assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert list(skew.hot_keys(large, "k", 0.1)) == [7]
    with pytest.raises(ValueError):
        skew.salted_join(large, small, "k", "full")


def test_late_events_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        event = 1_700_000_000_000 + i * 90_000
        rows.append((i, event, event + rng.choice([0, 1_000, 400_000, 1_500_000, 90_000_000])))
    df = spark.createDataFrame(rows, "id long, e long, a long")
    found = {r.id: r.watermark_ms for r in lateness.late_events(df, "e", "a").collect()}
    expected, seen, pending = {}, None, {}
    for i, event, arrival in rows:
        pending.setdefault(arrival // 300_000, []).append((i, event))
    for batch in sorted(pending):
        for i, event in pending[batch]:
            if seen is not None and event <= seen - 600_000:
                expected[i] = seen - 600_000
        seen = max([seen or 0, *(e for _, e in pending[batch])])
    assert found == expected and expected


def test_missing_events(spark):
    landed = spark.createDataFrame([(1, "c"), (2, None), (None, None), (3, "c"), (3, "c")], "id long, op string")
    stored = spark.createDataFrame([(1, "c"), (None, None)], "id long, op string")
    got = lateness.missing_events(landed, stored, ["id", "op"]).collect()
    assert sorted(map(str, got)) == ["Row(id=2, op=None)", "Row(id=3, op='c')"]


def test_freshness(spark):
    df = spark.createDataFrame([("a", 0, 30_000), ("a", 0, 30_001), ("b", 5, 5)], "t string, e long, p long")
    found = {r.t: tuple(r)[1:] for r in lateness.freshness(df, "e", "p", ["t"]).collect()}
    assert found == {"a": (2, 30.001, 1), "b": (1, 0.0, 0)}


CUSTOMERS = (
    "customer_id long, first_name string, last_name string, email string, city string, state string,"
    "created_at string, updated_at string"
)


def customer(i, name, updated, state="S1"):
    return (i, name, "L", f"c{i}@x.in", "City", state, "2026-01-01T00:00:00Z", updated)


def test_ingestion_from_csv_and_parquet(spark, tmp_path):
    batch, base = f"{tmp_path}/batch", str(tmp_path)
    rows = [customer(1, "old, \"quoted\"", "2026-01-01T00:00:00Z"), customer(1, "new", "2026-02-01T05:30:00+05:30"),
            customer(2, "  ", "2026-01-01T00:00:00Z", "S2"), customer(None, "x", "2026-01-01T00:00:00Z")]
    df = spark.createDataFrame(rows, CUSTOMERS)
    sinks.export_table(df, batch, "customers")
    as_csv = inputs.read_csv(spark, f"{batch}/customers.csv", df.schema)
    assert sorted(map(str, as_csv.collect())) == sorted(map(str, df.collect()))
    orders = [(1, 1, "PLACED", 5.0, dt.datetime(2026, 1, 1)), (2, 1, "PLACED", -5.0, None)]
    spark.createDataFrame(
        orders, "order_id long, customer_id long, order_status string, total_amount double, order_date timestamp"
    ).write.parquet(f"{batch}/orders.parquet")
    metrics = ingest.run_batch_ingestion(spark, batch, base)
    assert metrics == {"customers": 2, "products": None, "orders": 2, "order_items": None, "payments": None}
    silver = {r.customer_id: r for r in spark.read.parquet(f"{base}/silver/customers").collect()}
    assert silver[1].first_name == "new" and silver[1].updated_at == dt.datetime(2026, 2, 1)
    assert silver[2].state == "S2" and silver[2].ingestion_timestamp is not None
    assert ingest.ingest_table(spark, batch, base, "orders", profile="record") == 1
    assert [r.record_id for r in inputs.read_errors(spark, base).collect()] == ["2"]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("total_amount,order_id,extra\n1.5,7,x\noops,8,\n")
    rows = inputs.read_source(spark, str(tmp_path), "orders").collect()
    assert [(r.order_id, r.total_amount, r.extra) for r in rows] == [(7, 1.5, "x"), (8, None, None)]
    assert inputs.read_source(spark, str(tmp_path), "payments") is None


def test_partitioned_write_and_pruned_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("p"))
    assert sinks.write_table(df, path, ["p"]) == 1000
    assert len(glob.glob(f"{path}/p=*/*.parquet")) == 3  # one file each, not one per task
    part = inputs.read_partition(spark, path, p=1)
    assert part.count() == 333
    assert "PartitionFilters: [isnotnull(p" in part._jdf.queryExecution().executedPlan().toString()
    assert sinks.write_table(df, str(tmp_path / "u"), ["missing"]) == 1000


def test_backfill_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2026, 10, d) for d in (1, 1, 2)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id long, day date")
    sinks.write_table(df, path, ["day"])
    for _ in range(2):  # repeating it changes nothing
        upkeep.backfill_day(df.withColumn("id", F.col("id") + 100), path, "day", "2026-10-01")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 100, 101]


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(500).select("id", (F.col("id") % 2).alias("p"))
    df.repartition(10).write.partitionBy("p").parquet(path)
    before = len(glob.glob(f"{path}/p=0/*.parquet"))
    assert upkeep.compact_partition(spark, path, ["p"], p=0) == 250
    assert len(glob.glob(f"{path}/p=0/*.parquet")) < before
    assert len(glob.glob(f"{path}/p=1/*.parquet")) == before
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(500))


def test_schema_merge(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t/b=1")
    spark.range(2, 4).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/t/b=2")
    rows = inputs.read_parquet(spark, f"{tmp_path}/t", merge_schema=True).orderBy("id").collect()
    assert [r.x for r in rows] == [None, None, 1, 1]


def test_format_sizes(spark, tmp_path):
    df = spark.range(20_000).select("id", F.lit("DELIVERED").alias("s"))
    sizes = sinks.compare_formats(df, str(tmp_path), "orders")
    assert sizes["csv_bytes"] > sizes["parquet_bytes"] > 0 and sizes["size_ratio"] > 1


def test_batch_sequence(spark, tmp_path):
    batch, base = f"{tmp_path}/batch", str(tmp_path)
    spark.createDataFrame([customer(1, "A", "2026-01-01")], CUSTOMERS).write.parquet(f"{batch}/customers.parquet")
    spark.createDataFrame(
        [(1, "P", "Home", 2.0, 3), (2, "Q", "Home", -2.0, 3)],
        "product_id long, product_name string, category string, price double, stock_quantity int",
    ).write.parquet(f"{batch}/products.parquet")
    spark.createDataFrame(
        [(1, 1, "PLACED", 5.0, "2026-01-01")],
        "order_id long, customer_id long, order_status string, total_amount double, order_date string",
    ).write.parquet(f"{batch}/orders.parquet")
    spark.createDataFrame(
        [(1, 1, 1, 2, 2.5)], "order_item_id long, order_id long, product_id long, quantity int, unit_price double"
    ).write.parquet(f"{batch}/order_items.parquet")
    spark.createDataFrame(
        [(1, 1, "UPI", "SUCCESS", 5.0, "2026-01-01")],
        "payment_id long, order_id long, payment_method string, payment_status string, payment_amount double, payment_date string",
    ).write.parquet(f"{batch}/payments.parquet")
    with pytest.raises(QualityGateError, match="products: 1 of 2 rows invalid, most often price must be >= 0"):
        ingest.run_batch(spark, batch, base)
    result = ingest.run_batch(spark, batch, base, gate=False)
    assert result["rows"] == {"customers": 1, "products": 1, "orders": 1, "order_items": 1, "payments": 1}
    assert {r.tier: (r.is_active, r.row_count) for r in result["tiers"]} == {
        "bronze": (False, 0), "silver": (True, 5), "gold": (True, 4), "errors": (True, 1),
    }
    assert {r.source_table: r.dq_score for r in result["quality"]} == {
        "customers": 100.0, "products": 50.0, "orders": 100.0, "order_items": 100.0, "payments": 100.0,
    }
    again = ingest.run_batch(spark, batch, base, gate=False)
    assert [(t.tier, t.row_count) for t in again["tiers"]] == [(t.tier, t.row_count) for t in result["tiers"]]
    assert again["quality"] == result["quality"]


def test_rows_without_a_key_are_judged(spark, tmp_path):
    batch, base = f"{tmp_path}/batch", str(tmp_path)
    spark.createDataFrame(
        [(None, 1, "PLACED", 5.0), (None, 2, "PLACED", 5.0), (3, 1, "PLACED", 5.0), (3, 1, "PLACED", 4.0)],
        "order_id long, customer_id long, order_status string, total_amount double",
    ).write.parquet(f"{batch}/orders.parquet")
    loaded = ingest.load_table(spark, batch, base, "orders", profile="record")
    assert (loaded.rows, loaded.verdicts) == (1, (1, 2))
    errors = inputs.read_errors(spark, base).collect()
    assert [(r.record_id, r.validation_reason) for r in errors] == [(None, "order_id is NULL or missing")] * 2
    plain = ingest.load_table(spark, batch, f"{base}/plain", "orders")
    assert (plain.rows, plain.verdicts) == (1, None)


def test_errors_are_found_anywhere_below(spark, tmp_path):
    row = {"source_table": "orders", "record_id": "1", "validation_status": "INVALID", "validation_reason": "r"}
    frame = spark.createDataFrame([row])
    for place in ("errors/odd_name", "errors/batch_orders"):
        frame.write.parquet(f"{tmp_path}/{place}")
    frame.toPandas().to_parquet(f"{tmp_path}/errors/loose.parquet")
    assert inputs.read_errors(spark, str(tmp_path)).count() == 3
    assert inputs.read_errors(spark, f"{tmp_path}/nowhere").count() == 0
