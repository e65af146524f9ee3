"""Status transitions over all events of a key.

``lag`` over a window by key would sort each key in one task, a key with a third of the events
too. Here the events are range-partitioned by key and order, so that a busy key spans as many
ranges as it fills; ``lag`` runs inside a range, and only the first event of a key in a range
looks further: what came last before it is in a table with one row per key and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.state import operation_rank
from tidemark.session import staged

EVENTS_PER_RANGE = 500_000
RANGES_PER_CORE = 4


def ranges_by_key(
    rows: DataFrame, key: str, place: Column, rows_per_range: int = EVENTS_PER_RANGE
) -> DataFrame:
    """``_key, _place, _range``: rows cut into ranges of about ``rows_per_range`` rows, by key
    and place. Every range is a task, of which the driver hears; so where there would be more
    ranges than keep the cores busy they grow, up to ``EVENTS_PER_RANGE`` rows. Written, so
    that every use, and every repeated task, sees the same ranges."""
    placed = staged(rows.select(F.col(key).alias("_key"), place.alias("_place")), "places")
    count = placed.count()
    enough = RANGES_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, min(-(-count // rows_per_range), max(enough, -(-count // EVENTS_PER_RANGE))))
    ranged = placed.repartitionByRange(ranges, "_key", "_place")
    return staged(ranged.withColumn("_range", F.spark_partition_id()), "ranges")


def with_previous(ranged: DataFrame) -> DataFrame:
    """``ranged`` with ``_before``: the place before, of the same key; null for its first."""
    in_range = Window.partitionBy("_range", "_key").orderBy("_place")
    near = ranged.withColumn("_before", F.lag("_place").over(in_range))
    ends = ranged.groupBy("_key", "_range").agg(F.max("_place").alias("_last"))
    over_ranges = Window.partitionBy("_key").orderBy("_range")  # a row per range, not event
    carried = (
        ends.withColumn("_carry", F.lag("_last").over(over_ranges))
        .filter(F.col("_carry").isNotNull())
        .drop("_last")
    )
    first = near.filter(F.col("_before").isNull()).join(carried, ["_key", "_range"], "left")
    firsts = first.withColumn("_before", F.col("_carry")).select(*near.columns)
    return near.filter(F.col("_before").isNotNull()).unionByName(firsts)


def status_transitions(
    changes: DataFrame, key: str, status: str, events_per_range: int = EVENTS_PER_RANGE
) -> DataFrame:
    """One row per change of ``status`` of a key: the key, ``from_status, to_status,
    event_ts_ms`` and ``duration_ms``, how long the status before had lasted.

    Events follow each other by time, log position, operation and status. The first event of a
    key comes from no status and has no duration; events that keep the status are no
    transitions. A delete leads to a null status. Events without a key or a time are left out.
    """
    position = F.col("log_position") if "log_position" in changes.columns else F.lit(None)
    gone = F.coalesce(F.lower("operation") == "d", F.lit(False))
    place = F.struct(
        F.col("event_ts_ms").alias("at"),
        position.cast("long").alias("position"),
        operation_rank().alias("rank"),
        F.when(~gone, F.col(status)).alias("status"),
    )
    events = changes.filter(F.col(key).isNotNull() & F.col("event_ts_ms").isNotNull())
    steps = with_previous(ranges_by_key(events, key, place, events_per_range))
    old, new = F.col("_before.status"), F.col("_place.status")
    moved = steps.filter(F.col("_before").isNull() | ~old.eqNullSafe(new))
    moved = staged(moved.withColumn("_from", old).drop("_before"), "transitions")
    return with_previous(moved).select(
        F.col("_key").alias(key),
        F.col("_from").alias("from_status"),
        new.alias("to_status"),
        F.col("_place.at").alias("event_ts_ms"),
        (F.col("_place.at") - F.col("_before.at")).alias("duration_ms"),
    )
