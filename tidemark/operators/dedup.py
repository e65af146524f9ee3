"""Duplicate removal on events and on snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by every remaining column.

    Written as ``max`` of a struct. The aggregate runs partially before the shuffle, so
    each task sends at most one row per key and a key holding a third of the table
    costs no more than any other; a ``row_number`` window would sort that key in one
    task. The survivor does not depend on row order or on retries. Nulls are smallest.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(
        *[column.alias(f"_o{i}") for i, column in enumerate(order)], *[F.col(n) for n in rest]
    )
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    columns = [F.col(n) if n in keys else F.col(f"_best.{n}").alias(n) for n in df.columns]
    return best.select(*columns)


def snapshot(df: DataFrame, key: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Rows with a key, one per key; by default the latest ``updated_at`` survives."""
    if order is None:
        order = [F.col("updated_at")] if "updated_at" in df.columns else []
    return keep_greatest(df.filter(F.col(key).isNotNull()), [key], order)


def identified(df: DataFrame, key: str, extra: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` and the columns that tell its events apart.

    An event is its key, operation and time, and its position in the source's log where it
    has one: two changes of a key in one millisecond are two events. Rows without a key
    are told apart by their raw text, and by the message key where they have no text.
    """
    identity = [key, "operation", "event_ts_ms", *extra]
    if "log_position" in df.columns and "log_position" not in identity:
        identity.append("log_position")
    if "raw_payload" in df.columns:
        keyless = F.col(key).isNull()
        df = df.withColumn("_poison", F.when(keyless, F.col("raw_payload")))
        identity.append("_poison")
        if "message_key" in df.columns:
            empty = keyless & F.col("raw_payload").isNull()
            df = df.withColumn("_poison_key", F.when(empty, F.col("message_key")))
            identity.append("_poison_key")
    return df, identity


def distinct_events(df: DataFrame, key: str, extra: Sequence[str] = ()) -> DataFrame:
    """Batch: one row per event, nulls counting as equal. ``extra`` adds columns to what
    tells events apart."""
    marked, identity = identified(df, key, extra)
    return keep_greatest(marked, identity, []).drop("_poison", "_poison_key")


def distinct_events_stream(
    df: DataFrame,
    key: str,
    delay: str | None = "10 minutes",
    extra: Sequence[str] = (),
    arrival: str = "processing_time",
) -> DataFrame:
    """Streaming form of :func:`distinct_events`; every event comes out, however late.

    The watermark is on the time of arrival (column ``arrival``, added if missing), which
    is never behind it, so no event is dropped whatever its own time. With a ``delay`` the
    state forgets an event that long after its first arrival: copies that arrive further
    apart are both kept, which the latest-state jobs do not mind. ``delay=None`` remembers
    every event for ever, exact but with state that grows with the stream.
    """
    marked, identity = identified(df, key, extra)
    if delay is None:
        return marked.dropDuplicates(identity).drop("_poison", "_poison_key")
    added = arrival not in df.columns
    if added:
        marked = marked.withColumn(arrival, F.current_timestamp())
    once = marked.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(identity)
    return once.drop("_poison", "_poison_key", *([arrival] if added else []))


def merge_batches(loaded: DataFrame, retry: DataFrame, key: str) -> DataFrame:
    """Add a batch to loaded events. Re-running a batch changes nothing:
    ``dedup(dedup(a) + b)`` equals ``dedup(a + b)``."""
    return distinct_events(loaded.unionByName(retry, allowMissingColumns=True), key)
