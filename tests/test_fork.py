"""The forked stream: every output exactly once, whatever dies in between."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import deltas, ingest, marts
from tidemark.schemas import ENTITIES
from tidemark.session import STREAMING_SETTINGS
from tidemark.sources import tables as inputs
from tidemark.sources import warehouse as wh
from tidemark.sources.streams import landed_messages
from tidemark.sinks.keyed import KeyedTable
from tidemark.streaming import fork, identities, pipelines

SF = "/root/testdata/sf0.001"
ORDERS = ENTITIES["orders"]


@pytest.fixture(autouse=True)
def settings(spark):
    for name, value in STREAMING_SETTINGS.items():
        spark.conf.set(name, value)


@pytest.fixture
def landed(spark, tmp_path):
    messages = wh.order_messages(spark.read.parquet(f"{SF}/orders.parquet")).limit(900)
    path = str(tmp_path / "bronze")
    messages.withColumn("landed_at", F.current_timestamp()).repartition(3).write.parquet(path)
    return path


def start(spark, landed, base, **options):
    messages = landed_messages(spark, landed, max_files_per_trigger=1)
    query = fork.process_stream_fork(
        spark, messages, ORDERS, base, f"{base}/checkpoints", trigger={"availableNow": True},
        run_id="r", state_partitions=2, **options,
    )
    query.awaitTermination()
    return query


def stored(spark, base):
    accepted = spark.read.parquet(f"{base}/silver_changelog/orders")
    names = ("order_id", "operation", "event_ts_ms", "log_position", "order_status", "total_amount")
    rejected = inputs.read_errors(spark, base)
    shown = ("record_id", "operation", "validation_reason", "raw_payload")
    return [sorted(map(repr, df.select(*n).collect())) for df, n in ((accepted, names), (rejected, shown))]


def expected(spark, landed):
    accepted, rejected = pipelines.split_events(spark.read.parquet(landed), ORDERS)
    names = ("order_id", "operation", "event_ts_ms", "log_position", "order_status", "total_amount")
    shown = ("record_id", "operation", "validation_reason", "raw_payload")
    return [sorted(map(repr, df.select(*n).collect())) for df, n in ((accepted, names), (rejected, shown))]


class Dies(Exception):
    pass


def test_killed_between_the_two_writes(spark, landed, tmp_path, monkeypatch):
    base, write = str(tmp_path / "lake"), fork.write_batch

    def dying(rows, path, stream, batch_id, *rest):
        if batch_id == 1 and "/errors/" in path:
            raise Dies
        write(rows, path, stream, batch_id, *rest)

    monkeypatch.setattr(fork, "write_batch", dying)
    with pytest.raises(Exception, match="Dies"):
        start(spark, landed, base)
    half = stored(spark, base)
    monkeypatch.undo()
    query = start(spark, landed, base)
    whole = expected(spark, landed)
    assert len(half[0]) < len(whole[0]) and len(half[1]) < len(whole[1])
    assert stored(spark, base) == whole
    assert len(query.lastProgress["sources"]) == 1 and len(query.lastProgress["stateOperators"]) == 1


def test_a_new_checkpoint_does_not_replace_what_an_old_one_wrote(spark, landed, tmp_path):
    base = str(tmp_path / "lake")
    start(spark, landed, base)
    messages = landed_messages(spark, landed)
    fork.process_stream_fork(
        spark, messages, ORDERS, base, f"{base}/other", trigger={"availableNow": True}, run_id="q"
    ).awaitTermination()
    assert [len(side) for side in stored(spark, base)] == [2 * len(s) for s in expected(spark, landed)]


def test_marts_follow_though_the_stream_died(spark, landed, tmp_path):
    """The state has taken a batch in, the marts have not: the batch is run again."""
    base, gold, deaths = str(tmp_path / "lake"), str(tmp_path / "gold"), []

    def follow(merged, name):
        if name.endswith("-1") and not deaths:
            deaths.append(name)
            raise Dies
        deltas.advance_marts(spark, gold, name, {"orders": merged.changes})

    with pytest.raises(Exception, match="Dies"):
        start(spark, landed, base, keep_state=True, follow=follow)
    start(spark, landed, base, keep_state=True, follow=follow)
    rows = fork.latest_rows(spark, base, ORDERS)
    want = ingest.snapshot_of_messages(spark.read.parquet(landed), ORDERS)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.select(*rows.columns).collect()))
    mart, rebuilt = deltas.current_mart(spark, gold, "daily_sales", {}), marts.daily_sales_mart(want)
    assert sorted(map(repr, mart.collect())) == sorted(map(repr, rebuilt.select(*mart.columns).collect()))


def test_the_jobs_read_forked_streams(spark, landed, tmp_path):
    base = str(tmp_path / "lake")
    start(spark, landed, base)
    ingest.refresh_snapshot(spark, base, "orders")
    want = ingest.snapshot_of_messages(spark.read.parquet(landed), ORDERS)
    assert spark.read.parquet(f"{base}/silver/orders").count() == want.count()
    assert ingest.log_late_events(spark, base, "orders") >= 0


def test_tombstones_are_forgotten_on_demand(spark, tmp_path):
    row = "order_id long, operation string, event_ts_ms long, log_position long"
    payload = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS.payload if f.name != "order_id")
    none = tuple([None] * (len(ORDERS.columns) - 1))

    def changes(*rows):
        return spark.createDataFrame([(*r, *none) for r in rows], f"{row}, {payload}")

    table, errors = fork.state_table(spark, str(tmp_path), "orders"), inputs.empty_errors(spark)
    fork.advance(table, changes((1, "c", 10, 1), (2, "c", 10, 1), (1, "d", 20, 2)), errors, ORDERS)
    fork.advance(table, changes((1, "c", 15, 9)), errors, ORDERS)  # late, and deleted since
    assert [r.order_id for r in fork.latest_rows(spark, str(tmp_path), "orders").collect()] == [2]
    fork.advance(table, changes((2, "u", 30, 3)), errors, ORDERS, forget_before_ms=25)
    assert sorted((r.order_id, r.operation) for r in table.read().collect()) == [(2, "u")]


def test_copies_at_any_distance(spark, landed, tmp_path, monkeypatch):
    """Copies in other batches, after a restart, in a replay with a new checkpoint, and in a
    batch that is run again because its rows were not stored."""
    base, write = str(tmp_path / "lake"), fork.write_batch

    def dying(rows, path, stream, batch_id, *rest):
        if batch_id == 1:
            raise Dies
        write(rows, path, stream, batch_id, *rest)

    monkeypatch.setattr(fork, "write_batch", dying)
    with pytest.raises(Exception, match="Dies"):
        start(spark, landed, base, exact=True)
    monkeypatch.undo()
    query = start(spark, landed, base, exact=True)
    assert query.lastProgress["stateOperators"] == []
    messages = landed_messages(spark, landed)
    fork.process_stream_fork(
        spark, messages, ORDERS, base, f"{base}/other", trigger={"availableNow": True}, run_id="q", exact=True
    ).awaitTermination()
    assert stored(spark, base) == expected(spark, landed)


def test_identities_with_nulls_and_equal_hashes(spark, tmp_path, monkeypatch):
    schema = "order_id long, operation string, event_ts_ms long, log_position long"
    rows = [(1, "c", 5, None), (1, "c", None, 5), (None, "c", 5, 1), (None, None, None, None), (2, "u", 5, 1)]
    events = spark.createDataFrame(rows, schema)
    usual = identities._hash
    for name in ("honest", "colliding"):
        if name == "colliding":
            same = lambda seed, columns: F.lit(7).cast("long") if seed == 1 else usual(seed, columns)
            monkeypatch.setattr(identities, "_hash", same)
        table = KeyedTable(spark, str(tmp_path / name), "identity")
        first = identities.unseen(table, events.limit(3), "order_id", {"s": 0})
        assert first.count() == 3
        second = identities.unseen(table, events, "order_id", {"s": 1})
        assert sorted(map(repr, second.collect())) == sorted(map(repr, events.collect()[3:]))
        again = identities.unseen(table, events, "order_id", {"s": 1})
        assert again.count() == 2 and identities.unseen(table, events, "order_id").count() == 0


def test_an_exact_batch_is_read_once(spark, tmp_path, monkeypatch):
    from tidemark.streaming import fork

    levels, asked = [], fork.unseen

    def watched(table, events, key, mark=None):
        levels.append(events.storageLevel.useMemory or events.storageLevel.useDisk)
        return asked(table, events, key, mark)

    monkeypatch.setattr(fork, "unseen", watched)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("poison\n")
    lines = spark.readStream.format("text").load(f"{tmp_path}/in")
    fork.process_stream_fork(
        spark, lines, "orders", f"{tmp_path}/out", f"{tmp_path}/ckpt", trigger={"availableNow": True}, exact=True
    ).awaitTermination()
    assert levels == [True]
    assert spark.read.parquet(f"{tmp_path}/out/errors/orders").count() == 1
