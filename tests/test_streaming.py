import json

import pytest
from pyspark.sql import functions as F

from tests.test_events import image, message
from tidemark.operators.lateness import late_events, missing_events
from tidemark.plans import ingest
from tidemark.schemas import ENTITIES
from tidemark.sinks import tables as sinks
from tidemark.sinks import upkeep
from tidemark.sources.streams import kafka_messages, landed_messages, text_messages
from tidemark import __main__ as cli
from tidemark.sources.tables import judged_errors, read_changes, read_errors, read_judged, register_views
from tidemark.streaming import pipelines as p

NOW = {"availableNow": True}
ORDERS = ENTITIES["orders"]


class Lake:
    def __init__(self, spark, root, profile="stream", delay="10 minutes", start=p.process_orders_stream):
        self.spark, self.base, self.profile, self.delay = spark, str(root), profile, delay
        self.start, self.files = start, 0
        (root / "in").mkdir()

    def send(self, *lines):
        """One file, one micro-batch at least; runs the pipeline to the end of input."""
        self.files += 1
        with open(f"{self.base}/in/{self.files:03d}.txt", "w", encoding="utf-8") as handle:
            handle.write("\n".join(lines) + "\n")
        queries = self.start(
            self.spark, text_messages(self.spark, f"{self.base}/in"), self.base, f"{self.base}/ckpt",
            profile=self.profile, delay=self.delay, trigger=NOW,
        )
        p.await_all(self.spark, queries)

    def silver(self):
        rows = self.spark.read.parquet(f"{self.base}/silver_changelog/orders").collect()
        return sorted((r.order_id, r.operation, r.event_ts_ms) for r in rows)

    def errors(self):
        return {(r.record_id, r.validation_reason) for r in read_errors(self.spark, self.base).collect()}


T = 1700000000000


def test_reference_events(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(
        message(ts=T, after=image(1)),
        message(ts=T, after=image(1)),
        message("u", T + 1, after=image(1)),
        message(ts=None, after=image(2, amount=1.0)),
        message(ts=None, after=image(2, amount=9.0)),
        "garbage",
        message(ts=T, after=image(None)),
        message(ts=T, after=image(3, status=None, amount=None)),
        message(ts=T, after=image(4, status="BAD")),
        message(ts=T, after=image(6, status="placed")),
        message(ts=T, after=image(5, date="garbage")),
    )
    rows = spark.read.parquet(f"{lake.base}/silver_changelog/orders").collect()
    assert sorted((r.order_id, r.operation) for r in rows) == [(1, "c"), (1, "u"), (2, "c"), (3, "c"), (5, "c")]
    days = {r.order_id: r.order_date_dt for r in rows}
    assert days[5] is None and str(days[1]) == "2026-10-01"
    assert lake.errors() == {
        (None, "unparseable envelope"), (None, "order_id is null"),
        ("4", "invalid order_status enum"), ("6", "invalid order_status enum"),
    }


def test_restart_adds_only_new_rows(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(message(ts=T, after=image(1)), "garbage")
    lake.send(message(ts=T, after=image(1)), message(ts=T + 1000, after=image(2)))
    assert lake.silver() == [(1, "c", T), (2, "c", T + 1000)]
    assert read_errors(spark, lake.base).count() == 1


def test_bounded_dedup_keeps_late_events_and_the_log_names_them(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    hour, delay = 3_600_000, 600_000
    lake.send(message(ts=T, after=image(1)))
    lake.send(message(ts=T + hour, after=image(2)))
    lake.send(
        message(ts=T + 1, after=image(3)),
        message(ts=T + hour - 1, after=image(4)),
        message(ts=T + hour - delay, after=image(5)),  # exactly at the watermark
        message(ts=T + hour - delay + 1, after=image(6)),
        message(ts=T + 2, after=image(7, status="BAD")),
        message(ts=T, after=image(1)),  # a copy from two micro-batches ago
    )
    assert [r[0] for r in lake.silver()] == [1, 2, 3, 4, 5, 6]
    landed = p.split_events(spark.read.text(f"{lake.base}/in"), ORDERS, "stream")[0]
    stored = spark.read.parquet(f"{lake.base}/silver_changelog/orders")
    assert missing_events(landed, stored, ["order_id", "operation", "event_ts_ms"]).count() == 0
    assert ingest.log_late_events(spark, lake.base, "orders", delay) == 3
    late = spark.read.parquet(f"{lake.base}/late_events/orders").collect()
    assert {(r.record_id, r.watermark_ms) for r in late} == {
        (i, T + hour - delay) for i in ("3", "5", "7")
    }


def test_late_means_what_a_stream_leaves_out(spark, tmp_path):
    """An event exactly at the watermark of Spark's own late filter is late here too."""
    hour, delay = 3_600_000, 600_000
    batches = [[(1, T)], [(2, T + hour)], [(3, T + 1), (4, T + hour - 1), (5, T + hour - delay), (6, T + hour - delay + 1)]]
    (tmp_path / "in").mkdir()
    for k, rows in enumerate(batches):
        spark.createDataFrame([(i, t, k) for i, t in rows], "id long, t long, k int").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        timed = spark.readStream.schema("id long, t long, k int").parquet(f"{tmp_path}/in/*")
        timed = timed.withColumn("time", F.timestamp_millis("t")).withWatermark("time", "10 minutes")
        query = p.start_table(timed.dropDuplicatesWithinWatermark(["id"]), f"{tmp_path}/kept", f"{tmp_path}/ckpt", None, (), NOW)
        p.await_all(spark, [query])
    kept = {r.id for r in spark.read.parquet(f"{tmp_path}/kept").collect()}
    sent = spark.createDataFrame([(i, t, k) for k, rows in enumerate(batches) for i, t in rows], "id long, t long, k long")
    late = {r.id for r in late_events(sent, "t", "k", delay, 1).collect()}
    assert late == {3, 5} and kept == {1, 2, 4, 6}


@pytest.mark.parametrize("batches", [1, 2, 7])
@pytest.mark.parametrize("form", ["two", "one"])
def test_no_event_vanishes(spark, tmp_path, batches, form):
    """Accepted and rejected events are all distinct events, whatever the micro-batches."""
    day = 86_400_000
    lines = [message(ts=T + (i * 37 % 50) * day, after=image(i, status="BAD" if i % 9 == 0 else "PLACED")) for i in range(50)]
    lines += lines[:20] + [f"garbage {i}" for i in range(5)]
    one = lambda s, m, out, ck, **kw: [p.process_stream_once(s, m, "orders", out, ck, **kw)]
    lake = Lake(spark, tmp_path, **({} if form == "two" else {"start": one}))
    for k in range(batches):
        lake.send(*lines[k::batches])
    changes = read_changes(spark, lake.base, ORDERS)
    assert sorted(r.order_id for r in changes.collect()) == [i for i in range(50) if i % 9]
    assert read_errors(spark, lake.base).count() == 6 + 5


def test_two_changes_in_a_millisecond_and_empty_messages(spark, tmp_path):
    at = lambda lsn: {"source": {"lsn": lsn}}
    rows = [
        ("1", message("u", T, after=image(1, status="SHIPPED"), **at(1))),
        ("1", message("u", T, after=image(1, status="DELIVERED"), **at(2))),
        ("1", message("u", T, after=image(1, status="DELIVERED"), **at(2))),
        ("a", None), ("b", None), ("b", None), (None, "text"), ("c", "text"),
    ]
    raw = spark.createDataFrame(rows, "key string, value string")
    accepted, rejected = p.split_events(raw, ORDERS)
    assert sorted(r.order_status for r in accepted.collect()) == ["DELIVERED", "SHIPPED"]
    assert rejected.count() == 3  # two empty messages, one text
    raw.withColumn("landed_at", F.current_timestamp()).write.parquet(f"{tmp_path}/bronze")
    messages = landed_messages(spark, f"{tmp_path}/bronze", 1)
    p.await_all(spark, p.process_orders_stream(spark, messages, str(tmp_path), f"{tmp_path}/ckpt", trigger=NOW))
    assert spark.read.parquet(f"{tmp_path}/silver_changelog/orders").count() == 2
    assert read_errors(spark, str(tmp_path)).count() == 3


def test_field_of_wrong_type_is_named(spark):
    bad = message(ts=T, after={**image(1), "total_amount": "abc"})
    gone = message("d", T, before={**image(2), "total_amount": {"x": 1}})
    raw = spark.createDataFrame([(None, bad), (None, gone), (None, "{"), (None, "[1]")], "key string, value string")
    _, rejected = p.split_events(raw, ORDERS)
    assert sorted((r.record_id or "", r.validation_reason) for r in rejected.collect()) == [
        ("", "unparseable envelope"), ("", "unparseable envelope"),
        ("1", "total_amount must be >= 0, found: abc"),
        ("2", 'total_amount must be >= 0, found: {"x":1}'),
    ]


def test_stream_command(spark, tmp_path):
    """Options of the command reach the queries; every start has its own run id."""
    (tmp_path / "in").mkdir()
    (tmp_path / "rules.yaml").write_text(
        "rules:\n  orders:\n    required_fields: [order_id]\n    allowed_operations: [c]\n"
    )
    common = ["stream", "--bootstrap-servers", "x:1", "--output-base", str(tmp_path), "--checkpoint-base",
              f"{tmp_path}/ckpt", "--table", "orders", "--trigger", "availableNow", "--state-partitions", "2",
              "--profile", "declared", "--rules", f"{tmp_path}/rules.yaml", "--delay", "none"]
    for k, extra in enumerate((["--land-bronze"], ["--land-bronze"])):
        lines = [message("cu"[i % 2], T + i, after=image(10 * k + i)) for i in range(4)]
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(lines) + "\n")
        args = cli.arguments().parse_args([*common, *extra])
        p.await_all(spark, cli.start_streams(spark, args, lambda entity: text_messages(spark, f"{tmp_path}/in")))
    silver = spark.read.parquet(f"{tmp_path}/silver_changelog/orders").collect()
    assert sorted(r.order_id for r in silver) == [0, 2, 10, 12]
    assert {r.validation_reason for r in read_errors(spark, str(tmp_path)).collect()} == {"invalid operation"}
    runs = {r.pipeline_run_id for r in spark.read.parquet(f"{tmp_path}/ckpt/runs").collect()}
    assert {r.pipeline_run_id for r in silver} == runs and len(runs) == 2
    assert spark.read.parquet(f"{tmp_path}/bronze/orders").count() == 8
    assert len(list((tmp_path / "ckpt" / "orders_fork" / "state" / "0").glob("[0-9]*"))) == 2


def test_single_query_form_feeds_snapshots_views_and_audits(spark, tmp_path):
    lines = [
        message(ts=T, after=image(1)), message("u", T + 5, before=image(1), after=image(1, status="SHIPPED")),
        message(ts=T, after=image(2)), message("d", T + 6, before={"order_id": 2}), "garbage",
    ]
    one = lambda s, m, out, ck, **kw: [p.process_stream_once(s, m, "orders", out, ck, **kw)]
    lake = Lake(spark, tmp_path, profile="record", start=one)
    lake.send(*lines)
    assert ingest.refresh_snapshot(spark, lake.base, "orders") == 1
    assert ingest.advance_snapshot(spark, lake.base, "orders", None, f"{lake.base}/state") == 1
    register_views(spark, lake.base)
    assert spark.sql("SELECT order_status FROM orders_source").first()[0] == "SHIPPED"
    assert spark.sql("SELECT count(*) FROM errors_source").first()[0] == 2
    tiers = {r.tier: r.row_count for r in ingest.audit_lake(spark, lake.base).collect()}
    assert tiers["errors"] == 2 and tiers["silver"] == 1


def test_changelog_is_compacted_into_another_folder(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for i in range(3):
        lake.send(message(ts=T + i, after=image(i)))
    path, target = f"{lake.base}/silver_changelog/orders", f"{lake.base}/compacted/orders"
    assert upkeep.compact_changelog(spark, path, target, ["order_status"]) == 3
    assert len(list((tmp_path / "compacted" / "orders").rglob("*.parquet"))) == 1
    assert spark.read.parquet(target).count() == 3 and len(lake.silver()) == 3


def test_unbounded_dedup_keeps_late_events(spark, tmp_path):
    lake = Lake(spark, tmp_path, delay=None)
    hour = 3_600_000
    lake.send(message(ts=T + hour, after=image(2)))
    lake.send(message(ts=T, after=image(1)))
    lake.send(message(ts=T, after=image(1)))
    assert [r[0] for r in lake.silver()] == [1, 2]


def test_stream_equals_batch_and_refreshes_the_snapshot(spark, tmp_path):
    lines = [
        message(ts=T, after=image(1)),
        message("u", T + 5, before=image(1), after=image(1, status="SHIPPED")),
        message(ts=T, after=image(2)),
        message("d", T + 6, before={"order_id": 2}),
        message(ts=T, after=image(3)),
        message("d", T + 7, before=image(3)),
        message(ts=T, after=image(4)),
    ]
    lake = Lake(spark, tmp_path, profile="record")
    lake.send(*lines)
    accepted, rejected = p.split_events(spark.read.text(f"{lake.base}/in"), ORDERS, "record")
    assert sorted((r.order_id, r.operation, r.event_ts_ms) for r in accepted.collect()) == lake.silver()
    assert {(r.record_id, r.validation_reason) for r in rejected.collect()} == lake.errors()
    assert ingest.refresh_snapshot(spark, lake.base, "orders") == 2
    snapshot = spark.read.parquet(f"{lake.base}/silver/orders").collect()
    assert {r.order_id: r.order_status for r in snapshot} == {1: "SHIPPED", 4: "PLACED"}


def test_incremental_snapshot_equals_full_one(spark, tmp_path):
    lake = Lake(spark, tmp_path, profile="record", delay=None)
    silver, states = f"{lake.base}/silver/orders", f"{lake.base}/state"

    def rows():
        return {r.order_id: r.order_status for r in spark.read.parquet(silver).collect()}

    lake.send(*[message(ts=T, after=image(i)) for i in (1, 2, 3)], message("d", T + 9, before=image(3)))
    assert ingest.advance_snapshot(spark, lake.base, "orders", None, f"{states}/1") == 2
    between = spark.sql("SELECT cast(current_timestamp() AS string)").first()[0]
    lake.send(
        message("u", T + 5, before=image(1), after=image(1, status="SHIPPED")),
        message("u", T + 4, before=image(3), after=image(3, status="SHIPPED")),  # after its delete
        message("d", T + 6, before={"order_id": 2}),
        message(ts=T, after=image(4)),
    )
    assert ingest.advance_snapshot(spark, lake.base, "orders", f"{states}/1", f"{states}/2", between) == 2
    advanced = rows()
    assert advanced == {1: "SHIPPED", 4: "PLACED"}
    assert ingest.refresh_snapshot(spark, lake.base, "orders") == 2
    assert rows() == advanced


def test_state_partitions_belong_to_the_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(message(ts=T, after=image(1)) + "\n")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    query = p.process_stream_once(
        spark, text_messages(spark, f"{tmp_path}/in"), "orders", str(tmp_path), f"{tmp_path}/ckpt",
        trigger=NOW, state_partitions=3,
    )
    p.await_all(spark, [query])
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    assert len(list((tmp_path / "ckpt" / "orders_judged" / "state" / "0").glob("[0-9]*"))) == 3


def test_one_query_fork_equals_two(spark, tmp_path):
    lines = [message(ts=T, after=image(1)), message(ts=T, after=image(1)), "garbage", message(ts=T, after=image(2, None))]
    two = Lake(spark, tmp_path / "two" if (tmp_path / "two").mkdir() is None else tmp_path)
    two.send(*lines)
    (tmp_path / "one").mkdir()
    one = Lake(spark, tmp_path / "one", start=lambda s, m, out, ck, **kw: [p.process_stream_once(s, m, "orders", out, ck, **kw)])
    one.send(*lines)
    valid = read_judged(spark, one.base, "orders", "VALID")
    assert sorted((r.order_id, r.operation, r.event_ts_ms) for r in valid.collect()) == two.silver()
    assert {(r.record_id, r.validation_reason) for r in judged_errors(spark, one.base, "orders").collect()} == two.errors()
    assert "PartitionFilters: [isnotnull(validation_status" in valid._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "start, table, good, bad, reason",
    [
        (p.process_customer_stream, "customers",
         dict(customer_id=1, first_name="A", email="a@b.co", state="S"), dict(customer_id=2, first_name="A", email="x"),
         "invalid email format"),
        (p.process_payment_stream, "payments",
         dict(payment_id=1, payment_method="UPI", payment_status="SUCCESS", payment_amount=1.0),
         dict(payment_id=2, payment_method="CASH"), "invalid payment_method"),
        (p.process_product_stream, "products",
         dict(product_id=1, product_name="P", category="C", price=1.0, stock_quantity=1),
         dict(product_id=2, price=-1.0), "price must be >= 0, found: -1.0"),
        (p.process_order_item_stream, "order_items",
         dict(order_item_id=1, order_id=1, product_id=1, quantity=1, unit_price=1.0), dict(order_id=2),
         "order_item_id is null"),
    ],
)
def test_other_entities(spark, tmp_path, start, table, good, bad, reason):
    lake = Lake(spark, tmp_path, start=start)
    lake.send(message(ts=T, after=good), message(ts=T, after=good), message(ts=T, after=bad))
    key = ENTITIES[table].key
    assert [r[key] for r in spark.read.parquet(f"{lake.base}/silver_changelog/{table}").collect()] == [1]
    assert [reason for _, reason in lake.errors()] == [reason]


def test_landing_and_replay(spark, tmp_path):
    base = str(tmp_path)
    (tmp_path / "in").mkdir()
    lines = [message(ts=T, after=image(1)), "garbage", message(ts=T, after=image(2, None))]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    landing = p.land_messages(text_messages(spark, f"{base}/in"), f"{base}/bronze/orders", f"{base}/ckpt/bronze", NOW)
    p.await_all(spark, [landing])
    assert sorted(r.value for r in spark.read.parquet(f"{base}/bronze/orders").collect()) == sorted(lines)
    assert landed_messages(spark, f"{base}/bronze/orders").isStreaming
    assert ingest.replay(spark, f"{base}/bronze/orders", "orders", f"{base}/replayed") == {
        "silver_changelog": 1, "errors": 2,
    }


def test_batch_writers_keep_out_of_stream_folders(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(message(ts=T, after=image(1)))
    path = f"{lake.base}/silver_changelog/orders"
    rows = spark.read.parquet(path)
    with pytest.raises(ValueError, match="streaming query"):
        sinks.write_table(rows, path, mode="append")
    with pytest.raises(ValueError, match="streaming query"):
        upkeep.compact_partition(spark, path, ["order_status"], order_status="PLACED")
    assert lake.silver() == [(1, "c", T)]


def test_failed_query_is_reported(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    broken = text_messages(spark, f"{tmp_path}/in").select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    query = p.start_table(broken, f"{tmp_path}/out", f"{tmp_path}/ckpt", None, (), NOW)
    with pytest.raises(Exception, match="boom"):
        p.await_all(spark, [query])


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:1", ORDERS, 1000)


def test_messages_without_key_column(spark):
    df = spark.createDataFrame([(json.dumps({"op": "c"}).encode(),)], "value binary")
    assert p.message_text(df).first().message_key is None


def test_micro_batches_are_spread_by_their_rows(spark, tmp_path, monkeypatch):
    from tidemark.plans import registry

    rows, sf = 15_000, "/root/testdata/sf0.01"
    assert registry._row_count(spark, sf, "orders") == 15_000
    monkeypatch.setattr(registry, "_ROWS_PER_FILE", 100)
    monkeypatch.setattr(registry, "_ROWS_PER_STATE", 500)
    assert registry._states(spark, rows) == 30
    messages = spark.range(rows).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("value"))
    stream = registry._in_batches(spark, messages, str(tmp_path), "orders", rows, 3)
    sizes = spark.read.parquet(f"{tmp_path}/bronze/orders").groupBy(F.input_file_name()).count()
    assert sizes.count() == 150 and sizes.agg(F.max("count")).first()[0] < 200
    done = p.start_table(stream, f"{tmp_path}/out", f"{tmp_path}/state", None, (), {"availableNow": True})
    done.awaitTermination()
    taken = [batch.numInputRows for batch in done.recentProgress if batch.numInputRows]
    assert len(taken) == 3 and sum(taken) == rows


def test_a_forked_stream_leaves_no_core_idle(spark, monkeypatch):
    from tidemark.plans import registry

    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(registry, "_ROWS_PER_FILE", 20)  # 25 files of a micro-batch
    monkeypatch.setattr(registry, "_ROWS_PER_STATE", 100)  # 15 partitions
    base = registry._forked(spark, "/root/testdata/sf0.001", "stream", 2, 1)
    files = spark.read.parquet(f"{base}/bronze/orders").select(F.input_file_name()).distinct().count()
    state = spark.read.format("statestore").load(f"{base}/checkpoints/orders_fork")
    partitions = state.select("partition_id").distinct().count()
    assert files % (3 * cores) == 0 and files > 3 * cores
    assert partitions % cores == 0 and partitions > cores
