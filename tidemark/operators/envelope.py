"""Change envelopes: JSON text to typed, judged, enriched rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import iso_utc, now_ms, to_day
from tidemark.functions.text import show_text
from tidemark.operators.project import compute_once
from tidemark.operators.rules import Rule, rule, rules_for, with_verdict
from tidemark.schemas import CHANGE_OPERATIONS, CORRUPT, Entity, envelope_schema


def message_text(raw: DataFrame) -> DataFrame:
    """Message bytes as text: ``message_key`` (null if the source has none) and
    ``raw_payload``."""
    key = F.col("key").cast("string") if "key" in raw.columns else F.lit(None).cast("string")
    return raw.select(key.alias("message_key"), F.col("value").cast("string").alias("raw_payload"))


def parse_envelopes(raw: DataFrame, entity: Entity) -> DataFrame:
    """Parse ``value`` permissively. Nothing is dropped: text that is no envelope gives
    nulls and ``is_corrupt``.

    Columns: ``operation``, ``event_ts_ms``, ``log_position``, ``before``, ``after``,
    ``data`` (the image an operation acts on), ``is_corrupt``, ``message_key``,
    ``raw_payload``, ``processing_time``. Text counts as corrupt if nothing of an envelope
    could be read from it; an envelope with a field of the wrong type is no corrupt text,
    its field is null and left to the rules.
    """
    schema = envelope_schema(entity.payload)
    envelope = F.from_json("raw_payload", schema, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = compute_once(message_text(raw).select("*", envelope.alias("cdc")))
    operation = F.coalesce(F.nullif(F.col("cdc.op"), F.lit("")), F.col("cdc.operation"))
    unread = (
        F.col(f"cdc.{CORRUPT}").isNotNull()
        & F.coalesce("cdc.op", "cdc.operation").isNull()
        & F.col("cdc.ts_ms").isNull()
        & F.col("cdc.before").isNull()
        & F.col("cdc.after").isNull()
    )
    return parsed.select(
        operation.alias("operation"),
        F.col("cdc.ts_ms").alias("event_ts_ms"),
        F.col("cdc.source.lsn").alias("log_position"),
        F.col("cdc.before").alias("before"),
        F.col("cdc.after").alias("after"),
        active_image(operation, F.col("cdc.before"), F.col("cdc.after")).alias("data"),
        F.coalesce(unread, F.lit(False)).alias("is_corrupt"),
        "message_key",
        "raw_payload",
        F.current_timestamp().alias("processing_time"),
    )


def active_image(operation: Column, before: Column, after: Column) -> Column:
    """Deletes act on the row before the change, everything else on the row after it."""
    return F.when(F.lower(operation) == "d", before).otherwise(after)


def flatten(parsed: DataFrame, entity: Entity) -> DataFrame:
    """The active image as top-level columns next to the event's metadata."""
    return compute_once(
        parsed.select(
            "operation",
            "event_ts_ms",
            "log_position",
            *[F.col(f"data.{name}").alias(name) for name in entity.columns],
            F.col("data").isNull().alias("is_empty"),
            "is_corrupt",
            "message_key",
            "raw_payload",
            "processing_time",
        )
    )


def field_texts(entity: Entity) -> dict[str, Column]:
    """What the message says of a field whose value could not be read as its type."""
    deleted = F.lower("operation") == "d"
    return {
        name: F.when(deleted, F.get_json_object("raw_payload", f"$.before.{name}")).otherwise(
            F.get_json_object("raw_payload", f"$.after.{name}")
        )
        for name in entity.columns
    }


def envelope_rules() -> list[Rule]:
    """Checks of the envelope itself, before the rules of its table."""
    operation = F.col("operation")
    known = F.coalesce(F.lower(operation).isin(*CHANGE_OPERATIONS), F.lit(False))
    return [
        rule(
            ~known,
            F.concat(
                F.lit("invalid or missing CDC operation: '"), show_text(operation), F.lit("'")
            ),
        ),
        rule(
            F.col("is_empty"),
            F.concat(F.lit("payload for operation '"), F.lower(operation), F.lit("' is NULL")),
        ),
    ]


def event_rules(
    entity: Entity, profile: str, declaration: Mapping[str, Mapping] | None = None
) -> list[Rule]:
    """All rules an event passes. ``declaration`` replaces the built-in rule dictionary of
    the declared profile.

    ``record`` and ``declared`` judge the envelope first. ``stream`` judges only the row,
    plus the missing key that keeps an event from being stored at all.
    """
    if profile == "stream":
        return [
            rule(
                F.col(entity.key).isNull() & (F.col("is_corrupt") | F.col("operation").isNull()),
                "unparseable envelope",
            ),
            rule(F.col(entity.key).isNull(), f"{entity.key} is null"),
            *rules_for(entity.name, profile),
        ]
    unreadable = rule(F.col("is_corrupt"), "unparseable envelope")
    fields = rules_for(entity.name, profile, declaration, field_texts(entity))
    return [unreadable, *envelope_rules(), *fields]


def judge_events(
    flat: DataFrame,
    entity: Entity,
    profile: str = "record",
    declaration: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Verdict per event. Message key and raw text stay only with rejected events, so that
    good rows travel through the following shuffle without their JSON."""
    judged = with_verdict(flat, event_rules(entity, profile, declaration))
    rejected = F.col("validation_reason").isNotNull()
    kept = {n: F.when(rejected, F.col(n)) for n in ("message_key", "raw_payload")}
    return judged.withColumns(kept).drop("is_empty", "is_corrupt")


def read_events(
    raw: DataFrame,
    entity: Entity,
    profile: str = "record",
    declaration: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """``(key, value)`` messages to judged, flat events; duplicates still included."""
    flat = flatten(parse_envelopes(raw, entity), entity)
    return judge_events(flat, entity, profile, declaration)


def with_business_day(df: DataFrame, entity: Entity) -> DataFrame:
    """Add ``<date column>_dt`` where the entity has a business date."""
    if entity.date_column is None:
        return df
    return df.withColumn(f"{entity.date_column}_dt", to_day(entity.date_column))


def with_lineage(
    df: DataFrame, table: str, run_id: Column | str, processing_time: Column | None = None
) -> DataFrame:
    """Provenance columns of a record: source table, operation, event and processing
    time, and the id of the run that produced it."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    stamp = processing_time if processing_time is not None else F.current_timestamp()
    return df.withColumns(
        {
            "operation": F.lower("operation"),
            "source_table": F.lit(table),
            "event_timestamp": F.coalesce("event_ts_ms", now_ms()),
            "processing_timestamp": iso_utc(stamp),
            "pipeline_run_id": run,
        }
    )


def to_messages(events: DataFrame, entity: Entity, extra: Sequence[str] = ()) -> DataFrame:
    """Serialise ``(op, ts_ms, before, after, ...)`` rows to ``(key, value)`` JSON."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return events.select(
        image.getField(entity.key).cast("string").alias("key"),
        F.to_json(F.struct("op", "ts_ms", "before", "after", *extra)).alias("value"),
    )
