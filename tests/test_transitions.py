import random

from tidemark.operators import transitions
from tidemark.operators.transitions import ranges_by_key, status_transitions
from pyspark.sql import functions as F

SCHEMA = "order_id long, operation string, event_ts_ms long, log_position long, order_status string"
RANK = {"r": 0, "c": 1, "u": 2, "d": 3}


def expected(rows):
    found = []
    by_key = {}
    for row in rows:
        if row[0] is not None and row[2] is not None:
            by_key.setdefault(row[0], []).append(row)
    for key, events in by_key.items():
        none = lambda v: (v is not None, v or 0 if not isinstance(v, str) else v)
        state = lambda r: None if r[1] == "d" else r[4]
        events.sort(key=lambda r: (r[2], none(r[3]), RANK[r[1]], (state(r) is not None, state(r) or "")))
        last, since = None, None
        for place, event in enumerate(events):
            if place == 0 or state(event) != last:
                found.append((key, last, state(event), event[2], None if place == 0 else event[2] - since))
                last, since = state(event), event[2]
    return sorted(map(repr, found))


def some(dice, count):
    keys = [None, 1, 2, 3] + [7] * 6  # one key has more than half of the events
    for _ in range(count):
        at = dice.choice([None, *range(0, 400, 3)])
        yield (dice.choice(keys), dice.choice("rcuud"), at, dice.choice([None, *range(9)]), dice.choice(["A", "B", None]))


def test_against_plain_python(spark):
    rows = list(some(random.Random(1), 600))
    changes = spark.createDataFrame(rows, SCHEMA)
    for per_range in (500_000, 17):
        found = status_transitions(changes, "order_id", "order_status", per_range).collect()
        assert sorted(repr(tuple(r)) for r in found) == expected(rows)
    assert status_transitions(changes.limit(0), "order_id", "order_status").count() == 0


def test_a_busy_key_is_in_many_ranges(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("key"), "id"
    )
    ranged = ranges_by_key(rows, "key", F.struct("id"), 100)
    busy = ranged.filter("_key = 5").groupBy("_range").count().collect()
    assert len(busy) >= 8 and max(r["count"] for r in busy) < 400


def test_ranges_grow_where_they_would_be_too_many(spark):
    rows = spark.range(4_000).withColumn("user", F.col("id") % 3)
    found = transitions.ranges_by_key(rows, "user", F.struct(F.col("id").alias("at")), 5)
    sizes = found.groupBy("_range").count()
    cores = spark.sparkContext.defaultParallelism
    assert 3 < sizes.count() <= transitions.RANGES_PER_CORE * cores
    assert found.count() == 4_000 and sizes.agg(F.max("count")).first()[0] < 500
