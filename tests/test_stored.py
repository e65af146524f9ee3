"""A load against what is stored; freshness from sketches; audits of new batches only."""

import collections
import random

from pyspark.sql import functions as F

from tidemark.functions import bitmaps
from tidemark.functions.bitmaps import KeyFilter
from tidemark.operators import integrity, lateness
from tidemark.plans import ingest
from tidemark.sinks import upkeep
from tidemark.sources import tables as inputs
from tidemark.sources.tables import read_parquet
from tidemark.schemas import ENTITIES


def test_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS name")
    probes = spark.range(20000).selectExpr("id", "concat('k', id) AS name").repartition(3)
    passed = KeyFilter(keys, "name").passing(probes, "name")
    assert passed.columns == ["id", "name"]
    assert passed.filter("id < 5000").count() == 5000 and passed.filter("id >= 5000").count() < 1000
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    none = spark.createDataFrame([(None,)], "name string")
    assert KeyFilter(none, "name").passing(probes, "name").count() == 0


def test_a_filter_too_large_to_send_passes_all(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "MAX_BROADCAST_BITMAPS", 0)
    rows = spark.range(10).selectExpr("id AS name")
    assert KeyFilter(rows, "name").passing(rows, "name").count() == 10


def some(dice, count):
    return [(i, dice.choice([None, *(f"m{k}" for k in range(30))])) for i in range(count)]


def test_duplicates_and_orphans_over_two_loads(spark):
    dice = random.Random(3)
    stored, new = some(dice, 40), some(dice, 25)
    frames = [spark.createDataFrame(rows, "id long, mail string") for rows in (stored, new)]
    held, fresh = (collections.Counter(m for _, m in rows if m) for rows in (stored, new))
    want = {(m, held[m], n) for m, n in fresh.items() if held[m] + n > 1}
    found = integrity.duplicates_with_stored(*frames, "mail").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    parents = {m for _, m in stored if m}
    want = {(m, n) for m, n in fresh.items() if m not in parents}
    found = integrity.orphans_with_stored(frames[1], "mail", frames[0], "mail").collect()
    assert {tuple(r) for r in found} == want
    assert integrity.orphans_with_stored(frames[1], "mail", frames[0], "mail", frames[1]).count() == 0
    empty = frames[0].limit(0)
    assert integrity.duplicates_with_stored(frames[0], empty, "mail").count() == 0


def test_percentiles_of_merged_sketches(spark):
    dice = random.Random(4)
    rows = [(i % 7, 0, int(dice.expovariate(1 / 9000))) for i in range(20000)] + [(9, None, 5), (9, 5, None)]
    df = spark.createDataFrame(rows, "part int, sent long, arrived long")
    sketches = lateness.lag_sketches(df, "sent", "arrived", ["part"]).withColumn("all", F.lit(1))
    found = lateness.freshness_percentiles(sketches, ["all"]).collect()
    lags = sorted(r[2] for r in rows[:-2])
    assert [r.percentile for r in found] == list(lateness.PERCENTILES)
    for r in found:
        rank = sum(lag <= r.lag_ms for lag in lags) / len(lags)
        assert abs(rank - r.percentile) <= lateness.RANK_ERROR
        assert r.event_count == 20000 and r.max_lag_ms == lags[-1]
        assert r.sla_breaches == sum(lag > 30000 for lag in lags)


def lake(spark, base, batches):
    for number, (accepted, rejected) in batches:
        at = f"stream=s1/batch_id={number}"
        rows = spark.createDataFrame([(i, "c", t, "PLACED") for i, t in accepted], "order_id long, operation string, event_ts_ms long, order_status string")
        rows.write.mode("overwrite").partitionBy("order_status").parquet(f"{base}/silver_changelog/orders/{at}")
        bad = spark.createDataFrame([(str(i), "u", t) for i, t in rejected], "record_id string, operation string, event_timestamp long")
        bad.write.mode("overwrite").parquet(f"{base}/errors/orders/{at}")
        top = max((t for _, t in accepted + rejected), default=None)
        mark = spark.createDataFrame([(top,)], "greatest_event_ms long")
        mark.write.mode("overwrite").parquet(f"{base}/batch_summaries/orders/{at}")


def test_late_events_of_new_batches_only(spark, tmp_path):
    dice = random.Random(5)
    batches = []
    for number in range(5):
        events = [(10 * number + i, dice.randrange(0, 4_000)) for i in range(8)]
        batches.append((number, (events[:6], events[6:] if number != 2 else [])))
    batches[1] = (1, ([], []))
    want, seen = set(), None
    for number, (accepted, rejected) in batches:
        events = accepted + rejected
        want |= {(number, str(i), t, seen - 1000) for i, t in events if seen is not None and t <= seen - 1000}
        seen = max([t for _, t in events] + ([] if seen is None else [seen]), default=None)
    base = str(tmp_path)
    lake(spark, base, batches[:2])
    assert ingest.advance_late_events(spark, base, "orders", 1000) == 2
    lake(spark, base, batches[2:])
    # A batch audited before is not read again: its files may go.
    upkeep.remove_path(spark, f"{base}/silver_changelog/orders/stream=s1/batch_id=0")
    assert ingest.advance_late_events(spark, base, "orders", 1000) == 3
    assert ingest.advance_late_events(spark, base, "orders", 1000) == 0
    found = spark.read.parquet(f"{base}/late_events_by_batch/orders").collect()
    assert {(r.batch_id, r.record_id, r.event_ts_ms, r.watermark_ms) for r in found} == want and len(found) == len(want)
    counts = {r.batch_id: r.late_count for r in read_parquet(spark, f"{base}/late_counts/orders").collect()}
    assert counts == {n: sum(w[0] == n for w in want) for n in range(5)}


def test_compaction_beside_a_stream(spark, tmp_path):
    base, dice = str(tmp_path), random.Random(6)

    def seen():
        rows = inputs.read_changes(spark, base, ENTITIES["orders"])
        return sorted((r.order_id, r.event_ts_ms, r.order_status, r.batch_id) for r in rows.collect())

    batches = [(n, ([(10 * n + i, dice.randrange(99)) for i in range(6)], [])) for n in range(6)]
    lake(spark, base, batches[:4])

    def files_read():
        rows = inputs.read_changes(spark, base, ENTITIES["orders"])
        return rows.select(F.input_file_name()).distinct().count()

    before, files = seen(), files_read()
    # An attempt that died: its segment is no segment yet.
    broken = inputs.segment_path(base, "orders", "s1", 2)
    spark.range(3).selectExpr("id AS order_id", "'PLACED' AS order_status").write.partitionBy("order_status").parquet(broken)
    upkeep.remove_path(spark, f"{broken}/_SUCCESS")
    assert seen() == before
    assert upkeep.compact_batches(spark, base, "orders") == {"s1": 2}
    assert seen() == before and upkeep.compact_batches(spark, base, "orders") == {}
    assert files_read() < files
    lake(spark, base, batches[3:])  # the last batch once more, as a repeated one would be
    after = seen()
    assert len(after) == 36 and upkeep.remove_compacted(spark, base, "orders") == 3 and seen() == after
    assert upkeep.compact_batches(spark, base, "orders") == {"s1": 4} and seen() == after


def test_clustered_tables_are_read_in_part(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40_000).selectExpr("id", "id % 200 AS day", "hash(id) % 1000 AS customer", "cast(null AS double) AS x")
    usual = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert upkeep.write_clustered(rows, path, ["day", "customer", "x"]) == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", usual)
    for column in ("day", "customer"):
        found = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
            F.min(column).alias("low"), F.max(column).alias("high")
        ).collect()
        holding = [r for r in found if r.low <= 77 <= r.high]
        assert len(found) == 8 and len(holding) <= 5
    assert spark.read.parquet(path).filter("day = 77").count() == 200
