import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import envelope, state
from tidemark.operators.deadletter import dead_letters, for_topic
from tidemark.operators.dedup import distinct_events, keep_greatest, merge_batches, snapshot
from tidemark.schemas import ENTITIES, ERRORS
from tidemark.streaming.pipelines import split_events

ORDERS = ENTITIES["orders"]
EVENT = "order_id long, operation string, event_ts_ms long, order_status string, total_amount double"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


def image(order_id=1, customer_id=7, status="PLACED", amount=10.0, date="2026-10-01"):
    return dict(order_id=order_id, customer_id=customer_id, order_status=status,
                total_amount=amount, order_date=date, updated_at=date)


def message(op="c", ts=1700000000000, before=None, after=None, **extra):
    return json.dumps({"op": op, "ts_ms": ts, "before": before, "after": after, **extra})


def messages(spark, *values):
    return spark.createDataFrame([(None, v) for v in values], "key string, value string")


def test_duplicates_collapse(spark):
    t = 1700000000000
    df = events(spark, *[(1001, "c", t, "PLACED", 1.0)] * 3, (1002, "c", t + 100, "PLACED", 2.0))
    assert sorted(r.order_id for r in distinct_events(df, "order_id").collect()) == [1001, 1002]


def test_retry_changes_nothing(spark):
    first = events(spark, (2001, "c", 1, "A", 1.0), (2002, "c", 2, "A", 1.0))
    retry = events(spark, (2001, "c", 1, "A", 1.0), (2002, "c", 2, "A", 1.0), (2003, "c", 3, "A", 1.0))
    once = distinct_events(first, "order_id")
    merged = merge_batches(once, retry, "order_id")
    assert sorted(r.order_id for r in merged.collect()) == [2001, 2002, 2003]
    direct = distinct_events(first.unionByName(retry), "order_id")
    assert sorted(merged.collect()) == sorted(direct.collect())


def test_state_changes_survive(spark):
    df = events(spark, (3001, "c", 1, "PLACED", 1.0), (3001, "u", 2, "SHIPPED", 1.0),
                (3001, "u", 3, "DELIVERED", 1.0))
    kept = distinct_events(df, "order_id")
    assert kept.count() == 3
    wide = kept.withColumns({n: F.lit(None).cast("string") for n in ("customer_id", "order_date", "updated_at")})
    assert state.current_state(wide, ORDERS).first().order_status == "DELIVERED"


def test_null_times_count_as_equal(spark):
    df = events(spark, (2, "c", None, "A", 1.0), (2, "c", None, "A", 9.0))
    assert [r.total_amount for r in distinct_events(df, "order_id").collect()] == [9.0]


def test_survivor_does_not_depend_on_order(spark):
    rows = [(1, i % 3, i) for i in range(50)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "k long, a long, b long").repartition(parts)
        assert tuple(keep_greatest(df, ["k"], [F.col("a")]).first()) == (1, 2, 47)


def test_snapshot_keeps_latest_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", "2026-01-01"), (1, "b", "2026-02-01"), (1, "c", None), (None, "x", "2026-01-01")],
        "id long, v string, updated_at string",
    )
    assert [tuple(r) for r in snapshot(df, "id").collect()] == [(1, "b", "2026-02-01")]


def test_envelope_validation(spark):
    raw = messages(
        spark,
        message(after=image(9001, 105, "CONFIRMED", 1200.0)),
        message(op="D", before=image(2), after=None),
        message(op="x", after=image(3)),
        message(op="u", after=None),
        json.dumps({"operation": "r", "ts_ms": 1, "after": image(5)}),
        json.dumps({"ts_ms": 1, "after": image(6)}),
        "garbage",
        message(after=image(None)),
    )
    found = {
        (r.order_id, r.operation): r.validation_reason
        for r in envelope.read_events(raw, ORDERS).collect()
    }
    assert found == {
        (9001, "c"): None,
        (2, "D"): None,
        (3, "x"): "invalid or missing CDC operation: 'x'",
        (None, "u"): "payload for operation 'u' is NULL",
        (5, "r"): None,
        (6, None): "invalid or missing CDC operation: 'None'",
        (None, None): "unparseable envelope",
        (None, "c"): "order_id is NULL or missing",
    }


def test_lineage(spark):
    judged = envelope.read_events(messages(spark, message(op="C", ts=None, after=image())), ORDERS)
    row = envelope.with_lineage(judged, "orders", "run-1").first()
    assert (row.operation, row.source_table, row.pipeline_run_id) == ("c", "orders", "run-1")
    assert row.event_timestamp > 1_700_000_000_000 and row.processing_timestamp.endswith("+00:00")


def test_split_is_complete_and_uniform(spark):
    raw = messages(spark, message(after=image()), message(after=image()), "garbage", "rubbish", "rubbish",
                   message(after=image(2, None)))
    accepted, rejected = split_events(raw, ORDERS)
    assert accepted.count() == 1
    assert rejected.schema.fieldNames() == ERRORS.fieldNames()
    errors = {r.raw_payload: r for r in rejected.collect()}
    assert set(errors) == {"garbage", "rubbish", message(after=image(2, None))}
    bad = errors[message(after=image(2, None))]
    assert (bad.source_table, bad.record_id, bad.operation, bad.event_timestamp) == (
        "orders", "2", "c", 1700000000000,
    )


def test_dead_letter_of_a_plain_record(spark):
    from tidemark.operators.rules import validate

    df = spark.createDataFrame([(1, 2, "PLACED", -1.0)], "order_id long, customer_id long, order_status string, total_amount double")
    row = dead_letters(validate(df, "orders"), ORDERS, "r").first()
    assert json.loads(row.raw_payload) == {
        "order_id": 1, "customer_id": 2, "order_status": "PLACED", "total_amount": -1.0,
    }
    sent = for_topic(dead_letters(validate(df, "orders"), ORDERS, "r")).first()
    assert sent.key == "1" and json.loads(sent.value)["validation_status"] == "INVALID"


def changes(spark, *rows):
    """rows: (order_id, op, ts, lsn, status)"""
    df = spark.createDataFrame(
        list(rows), "order_id long, operation string, event_ts_ms long, log_position long, order_status string"
    )
    return df.withColumns(
        {
            "customer_id": F.lit(1).cast("long"),
            "total_amount": F.lit(1.0),
            "order_date": F.lit("2026-01-01"),
            "updated_at": F.lit("2026-01-01"),
        }
    )


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, "c", 5, None, "A"), (1, "u", 9, None, "B"), (1, "u", 7, None, "C")], {1: "B"}),
        ([(1, "c", 5, None, "A"), (1, "d", 9, None, "A"), (1, "u", 7, None, "C")], {}),
        ([(1, "u", 5, None, "B"), (1, "d", 5, None, "A"), (1, "c", 5, None, "A")], {}),
        ([(1, "u", 5, 2, "B"), (1, "d", 5, 1, "A")], {1: "B"}),
        ([(None, "c", 5, None, "A"), (2, "r", None, None, "Z")], {2: "Z"}),
        ([(1, "d", 5, None, "A"), (1, "c", 6, None, "N")], {1: "N"}),
    ],
)
def test_latest_state(spark, rows, expected):
    found = state.current_state(changes(spark, *rows), ORDERS).collect()
    assert {r.order_id: r.order_status for r in found} == expected


def test_late_update_does_not_resurrect(spark):
    known = state.latest_changes(changes(spark, (1, "c", 5, None, "A"), (1, "d", 9, None, "A")), ORDERS)
    later = state.advance_state(known, changes(spark, (1, "u", 7, None, "B"), (2, "c", 1, None, "N")), ORDERS)
    assert [r.order_id for r in state.live_rows(later, ORDERS).collect()] == [2]


def test_rejected_delete_still_deletes(spark):
    raw = messages(
        spark,
        message(ts=1, after=image(1)),
        message(op="d", ts=2, before={"order_id": 1}),
        message(ts=1, after=image(2)),
    )
    accepted, rejected = split_events(raw, ORDERS)
    changes = state.change_columns(accepted, ORDERS)
    changes = changes.unionByName(state.rejected_deletes(rejected, ORDERS))
    assert [r.order_id for r in state.current_state(changes, ORDERS).collect()] == [2]


def test_rejected_delete_of_the_same_millisecond(spark):
    raw = messages(
        spark,
        message(ts=5, after=image(1), source={"lsn": 8}),
        message(op="d", ts=5, before={"order_id": 1}, source={"lsn": 9}),
    )
    accepted, rejected = split_events(raw, ORDERS)
    changes = state.change_columns(accepted, ORDERS)
    changes = changes.unionByName(state.rejected_deletes(rejected, ORDERS))
    assert state.current_state(changes, ORDERS).count() == 0


def test_change_audit(spark):
    raw = messages(
        spark,
        message(op="u", before=image(1, amount=10.0), after=image(1, status="SHIPPED", amount=12.0)),
        message(op="u", before={"order_id": 2}, after={"order_id": 2, "order_status": "PLACED"}),
        message(op="c", after=image(3)),
    )
    found = state.change_audit(envelope.parse_envelopes(raw, ORDERS), ORDERS).collect()
    assert sorted((r.order_id, r.attribute, r.old_value, r.new_value) for r in found) == [
        (1, "order_status", "PLACED", "SHIPPED"),
        (1, "total_amount", "10.0", "12.0"),
        (2, "order_status", None, "PLACED"),
    ]


def test_messages_round_trip(spark):
    raw = messages(spark, message(after=image(4), source={"lsn": 17}))
    parsed = envelope.parse_envelopes(raw, ORDERS)
    again = envelope.to_messages(
        parsed.select(F.col("operation").alias("op"), F.col("event_ts_ms").alias("ts_ms"), "before", "after"),
        ORDERS,
    )
    assert again.first().key == "4"
    assert envelope.parse_envelopes(again, ORDERS).first().data == parsed.first().data
