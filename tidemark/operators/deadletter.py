"""The dead-letter table: one shape for every rejected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import iso_utc, now_ms
from tidemark.operators.rules import invalid_rows
from tidemark.schemas import ERRORS, Entity


def _optional(df: DataFrame, name: str, otherwise: Column) -> Column:
    return F.coalesce(F.col(name), otherwise) if name in df.columns else otherwise


def dead_letters(
    judged: DataFrame,
    entity: Entity,
    run_id: str,
    processing_time: Column | None = None,
) -> DataFrame:
    """Rejected rows of a judged frame as dead-letter records.

    The payload is the message as it arrived; a record that never was a message is
    written as JSON of its columns.
    """
    stamp = processing_time if processing_time is not None else F.current_timestamp()
    columns = [name for name in entity.columns if name in judged.columns]
    record_json = F.to_json(F.struct(*[F.col(name) for name in columns]))
    null_text = F.lit(None).cast("string")
    return invalid_rows(judged).select(
        F.lit(entity.name).alias("source_table"),
        F.col(entity.key).cast("string").alias("record_id"),
        F.lower(_optional(judged, "operation", null_text)).alias("operation"),
        _optional(judged, "event_ts_ms", now_ms()).alias("event_timestamp"),
        iso_utc(stamp).alias("processing_timestamp"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.col("validation_status"),
        F.col("validation_reason"),
        _optional(judged, "raw_payload", record_json).alias("raw_payload"),
    )


def for_topic(errors: DataFrame) -> DataFrame:
    """Dead letters as ``(key, value)`` messages."""
    return errors.select(
        F.col("record_id").alias("key"),
        F.to_json(F.struct(*[F.col(name) for name in ERRORS.fieldNames()])).alias("value"),
    )
