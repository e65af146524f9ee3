"""Current state and change history derived from an event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_greatest
from tidemark.schemas import Entity


def operation_rank(operation: Column | str = "operation") -> Column:
    # Inside one millisecond: snapshot read, create, update, delete. The letters
    # themselves sort otherwise and would let an update beat a delete.
    operation = F.lower(operation)
    return (
        F.when(operation == "r", 0)
        .when(operation == "c", 1)
        .when(operation == "u", 2)
        .when(operation == "d", 3)
        .otherwise(-1)
    )


def change_columns(changes: DataFrame, entity: Entity) -> DataFrame:
    """Key, position and payload of changes, the columns a state is made of."""
    if "log_position" not in changes.columns:
        changes = changes.withColumn("log_position", F.lit(None).cast("long"))
    payload = [name for name in entity.columns if name != entity.key]
    return changes.select(entity.key, "operation", "event_ts_ms", "log_position", *payload)


def latest_changes(changes: DataFrame, entity: Entity) -> DataFrame:
    """The last change of every key, deletes kept as tombstones.

    Order: event time, then log position, then operation. One aggregate with map-side
    combine, so a key with very many changes is reduced before the shuffle.
    """
    return keep_greatest(
        change_columns(changes, entity).filter(F.col(entity.key).isNotNull()),
        [entity.key],
        [F.col("event_ts_ms"), F.col("log_position"), operation_rank()],
    )


def live_rows(latest: DataFrame, entity: Entity) -> DataFrame:
    """Rows that exist now: everything whose last change is no delete."""
    return latest.filter(F.lower("operation") != "d").select(*entity.columns)


def current_state(changes: DataFrame, entity: Entity) -> DataFrame:
    return live_rows(latest_changes(changes, entity), entity)


def advance_state(latest: DataFrame, changes: DataFrame, entity: Entity) -> DataFrame:
    """Fold new changes into known last changes. Older events that arrive late lose
    against the tombstone or the newer change already known."""
    return latest_changes(latest.unionByName(change_columns(changes, entity)), entity)


def rejected_deletes(errors: DataFrame, entity: Entity) -> DataFrame:
    """Deletes in the dead-letter table as tombstones.

    A delete needs its key and time only; one whose old row fails a quality rule must
    still remove the key from the current state.
    """
    key_type = entity.payload[entity.key].dataType
    payload = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in entity.payload
        if field.name != entity.key
    ]
    return errors.filter(
        (F.col("source_table") == entity.name)
        & (F.col("operation") == "d")
        & F.col("record_id").isNotNull()
    ).select(
        F.col("record_id").try_cast(key_type).alias(entity.key),
        "operation",
        F.col("event_timestamp").alias("event_ts_ms"),
        F.get_json_object("raw_payload", "$.source.lsn").try_cast("long").alias("log_position"),
        *payload,
    )


def change_audit(
    parsed: DataFrame, entity: Entity, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per attribute an update changed: old and new value as text.

    Works on the two images inside each event, so no event waits for its predecessor and
    nothing is shuffled. Attributes missing from a partial ``before`` read as null.
    """
    names = [n for n in (columns or entity.columns) if n != entity.key]
    before, after = F.col("before"), F.col("after")
    deltas = F.array(
        *[
            F.struct(
                F.lit(name).alias("attribute"),
                before.getField(name).cast("string").alias("old_value"),
                after.getField(name).cast("string").alias("new_value"),
            )
            for name in names
        ]
    )
    changed = F.filter(deltas, lambda d: ~d["old_value"].eqNullSafe(d["new_value"]))
    return (
        parsed.filter((F.lower("operation") == "u") & before.isNotNull() & after.isNotNull())
        .select(
            after.getField(entity.key).alias(entity.key),
            "event_ts_ms",
            F.explode(changed).alias("delta"),
        )
        .select(entity.key, "event_ts_ms", "delta.attribute", "delta.old_value", "delta.new_value")
    )
