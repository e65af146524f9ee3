"""Jobs that fill the lake: batch files to silver, change logs to snapshots, replays."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import iso_utc
from tidemark.operators.deadletter import dead_letters
from tidemark.operators.dedup import snapshot
from tidemark.operators.envelope import read_events
from tidemark.operators.lateness import freshness_percentiles, late_events
from tidemark.operators.quality import score_counts, share_gate, tier_audit
from tidemark.operators.rules import INVALID, VALID, invalid_rows, valid_rows, validate
from tidemark.operators.state import (
    change_columns,
    current_state,
    latest_changes,
    live_rows,
    rejected_deletes,
)
from tidemark.plans.marts import run_transformations
from tidemark.schemas import ENTITIES, Entity
from tidemark.session import remove_path, scratch_dir, staged
from tidemark.sinks.tables import replace_rejects, write_table
from tidemark.sinks.upkeep import replace_partitions
from tidemark.sources.tables import (
    read_changes,
    read_entity_errors,
    read_errors,
    read_parquet,
    read_source,
)
from tidemark.streaming.pipelines import split_events

log = logging.getLogger(__name__)

_TIME_COLUMNS = ("created_at", "updated_at", "order_date", "payment_date")


def normalize_times(df: DataFrame) -> DataFrame:
    """Text instants become timestamps, so that CSV, Parquet and change-log input agree."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    changes = {
        name: F.col(name).try_cast("timestamp") for name in _TIME_COLUMNS if name in text
    }
    return df.withColumns(changes) if changes else df


@dataclass(frozen=True)
class Loaded:
    """What one batch file came to. ``verdicts`` are valid and invalid rows of all that
    came in, None if nothing was judged."""

    rows: int
    verdicts: tuple[int, int] | None


def load_table(
    spark: SparkSession,
    input_dir: str,
    output_base: str,
    table: str,
    partition_by: tuple[str, ...] | None = None,
    profile: str | None = None,
    run_id: str = "batch",
    declaration: Mapping[str, Mapping] | None = None,
) -> Loaded | None:
    """Load one batch file into ``silver/<table>``: rows with a key, one per key, stamped.

    None if there is no file. With ``profile`` the rows are also judged, those without a
    key too: rejected ones replace the table's dead letters of the run before. Reading,
    one row per key and the rules run once, into a staged table from which both sides are
    written; the verdicts are counted by the job that writes it.
    """
    source = read_source(spark, input_dir, table)
    if source is None:
        return None
    entity = ENTITIES.get(table)
    rows = normalize_times(source)
    keyless = None
    if entity is not None and entity.key in rows.columns:
        versions = [F.col(n) for n in (entity.version_column,) if n in rows.columns]
        keyless = rows.filter(F.col(entity.key).isNull())
        rows = snapshot(rows, entity.key, versions)
    if partition_by is None:
        partition_by = entity.partition_by if entity is not None else ()
    silver = f"{output_base.rstrip('/')}/silver/{table}"
    if profile is None or entity is None:
        stamped = rows.withColumn("ingestion_timestamp", F.current_timestamp())
        return Loaded(write_table(stamped, silver, partition_by), None)

    everything = rows if keyless is None else rows.unionByName(keyless)
    counted = Observation()
    status = F.col("validation_status")
    judged = validate(everything, table, profile, declaration).observe(
        counted,
        F.count_if(status == VALID).alias("valid"),
        F.count_if(status == INVALID).alias("invalid"),
    )
    staging = scratch_dir(spark, f"judged-{table}")
    judged.write.parquet(staging)
    held = spark.read.schema(judged.schema).parquet(staging)
    replace_rejects(dead_letters(invalid_rows(held), entity, run_id), output_base, table)
    accepted = valid_rows(held).drop("validation_status", "validation_reason")
    stamped = accepted.withColumn("ingestion_timestamp", F.current_timestamp())
    written = write_table(stamped, silver, partition_by)
    verdicts = (counted.get["valid"], counted.get["invalid"])
    remove_path(spark, staging)
    return Loaded(written, verdicts)


def ingest_table(spark: SparkSession, input_dir: str, output_base: str, table: str, **options) -> int | None:
    """:func:`load_table`, giving the rows written, or None if there was no file."""
    loaded = load_table(spark, input_dir, output_base, table, **options)
    return None if loaded is None else loaded.rows


def _load_all(spark, input_dir, output_base, profile, declaration) -> dict[str, Loaded | None]:
    run_id = str(uuid.uuid4())
    loaded = {
        table: load_table(
            spark, input_dir, output_base, table,
            profile=profile, run_id=run_id, declaration=declaration,
        )
        for table in ENTITIES
    }
    log.info("batch ingestion: %s", loaded)
    return loaded


def _rows(loaded: Mapping[str, Loaded | None]) -> dict[str, int | None]:
    return {table: None if found is None else found.rows for table, found in loaded.items()}


def run_batch_ingestion(
    spark: SparkSession,
    input_dir: str,
    output_base: str,
    profile: str | None = None,
    declaration: Mapping[str, Mapping] | None = None,
) -> dict[str, int | None]:
    """Load all five tables; rows per table, None where there was no file."""
    return _rows(_load_all(spark, input_dir, output_base, profile, declaration))


def _changes(spark: SparkSession, base: str, entity: Entity) -> DataFrame:
    changes = read_changes(spark, base, entity)
    if changes is None:
        raise ValueError(f"no change log of {entity.name} below {base}")
    return changes


def refresh_snapshot(spark: SparkSession, output_base: str, entity: Entity | str) -> int:
    """Rebuild ``silver/<table>`` from its change log, of either form of the stream. Deletes
    that were rejected for the quality of their old row still delete."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base = output_base.rstrip("/")
    changes = change_columns(_changes(spark, base, entity), entity)
    errors = read_entity_errors(spark, base, entity)
    if errors is not None:
        changes = changes.unionByName(rejected_deletes(errors, entity))
    rows = normalize_times(current_state(changes, entity))
    stamped = rows.withColumn("ingestion_timestamp", F.current_timestamp())
    return write_table(stamped, f"{base}/silver/{entity.name}", entity.partition_by)


def advance_snapshot(
    spark: SparkSession,
    output_base: str,
    entity: Entity | str,
    state_in: str | None,
    state_out: str,
    since: str | None = None,
) -> int:
    """Rebuild ``silver/<table>`` from an earlier state and the changes since.

    ``state_in`` holds the last change of every key, deletes included; the advanced state
    is written to ``state_out``, another folder, so a failed run can be repeated. Only
    change-log files with rows processed at or after ``since`` are read. Changes seen
    twice do no harm, so ``since`` may overlap the previous run.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base = output_base.rstrip("/")
    changes = _changes(spark, base, entity)
    errors = read_entity_errors(spark, base, entity)
    if since is not None:
        start = F.lit(since).cast("timestamp")
        changes = changes.filter(F.col("processing_time") >= start)
        if errors is not None:
            errors = errors.filter(F.col("processing_timestamp") >= iso_utc(start))
    changes = change_columns(changes, entity)
    if errors is not None:
        changes = changes.unionByName(rejected_deletes(errors, entity))
    if state_in is not None:
        changes = changes.unionByName(spark.read.parquet(state_in))
    write_table(latest_changes(changes, entity), state_out)
    rows = normalize_times(live_rows(spark.read.parquet(state_out), entity))
    stamped = rows.withColumn("ingestion_timestamp", F.current_timestamp())
    return write_table(stamped, f"{base}/silver/{entity.name}", entity.partition_by)


def log_late_events(
    spark: SparkSession, output_base: str, entity: Entity | str, delay_ms: int = 600_000
) -> int:
    """Write ``late_events/<table>``: the stored events, accepted or rejected, that were
    older than the greatest event time of all earlier micro-batches minus the delay. The
    rows of a micro-batch share its processing time, so its order is known from the
    tables."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base = output_base.rstrip("/")
    stamp = F.to_timestamp("processing_timestamp")
    events = _changes(spark, base, entity).select(
        F.col(entity.key).cast("string").alias("record_id"),
        "operation",
        "event_ts_ms",
        F.unix_millis(stamp).alias("processing_ms"),
    )
    errors = read_entity_errors(spark, base, entity)
    if errors is not None:
        # A dead letter without an event time has its processing time there: never late.
        events = events.unionByName(
            errors.select(
                "record_id",
                "operation",
                F.col("event_timestamp").alias("event_ts_ms"),
                F.unix_millis(stamp).alias("processing_ms"),
            )
        )
    late = late_events(events, "event_ts_ms", "processing_ms", delay_ms, 1)
    return write_table(late, f"{base}/late_events/{entity.name}")


def advance_late_events(
    spark: SparkSession, output_base: str, entity: Entity | str, delay_ms: int = 600_000
) -> int:
    """Audit the micro-batches of a forked stream that were not audited before: add their
    events older than the greatest event time of all batches before them, minus the delay, to
    ``late_events_by_batch/<table>``; returns the batches audited.

    The mark of every batch comes from the summaries the stream wrote, one row a batch; of the
    stored events only new batches are read. What was audited is in ``late_counts/<table>``.
    A run that died is repeated by the next and gives the same rows.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base, batch = output_base.rstrip("/"), ["stream", "batch_id"]
    earlier = Window.partitionBy("stream").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    greatest = F.max("greatest_event_ms").over(earlier)
    marks = spark.read.parquet(f"{base}/batch_summaries/{entity.name}").select(
        *batch, (greatest - delay_ms).alias("watermark_ms")
    )
    audited = read_parquet(spark, f"{base}/late_counts/{entity.name}")
    if audited is not None:
        marks = marks.join(audited.select(*batch), batch, "left_anti")
    marks = staged(marks, "marks")
    new = marks.groupBy("stream").agg(F.min("batch_id").alias("first"), F.count("*").alias("n")).collect()
    if not new:
        return 0
    unread = F.lit(False)
    for row in new:  # one a stream; prunes the folders of older batches
        unread = unread | ((F.col("stream") == row.stream) & (F.col("batch_id") >= row.first))
    accepted = spark.read.parquet(f"{base}/silver_changelog/{entity.name}").filter(unread)
    events = accepted.select(
        *batch, F.col(entity.key).cast("string").alias("record_id"), "operation", "event_ts_ms"
    )
    rejected = read_parquet(spark, f"{base}/errors/{entity.name}")
    if rejected is not None:
        time = F.col("event_timestamp").alias("event_ts_ms")
        events = events.unionByName(rejected.filter(unread).select(*batch, "record_id", "operation", time))
    late = events.join(marks, batch).filter(F.col("event_ts_ms") <= F.col("watermark_ms"))
    found = f"{base}/late_events_by_batch/{entity.name}"
    replace_partitions(late, found, batch)
    counted = read_parquet(spark, found)
    counts = marks.select(*batch)
    if counted is not None:
        numbers = counted.filter(unread).groupBy(*batch).agg(F.count("*").alias("late_count"))
        counts = counts.join(numbers, batch, "left").fillna(0, ["late_count"])
    else:
        counts = counts.withColumn("late_count", F.lit(0).cast("long"))
    replace_partitions(counts, f"{base}/late_counts/{entity.name}", batch)
    return sum(row.n for row in new)


def stream_freshness(spark: SparkSession, output_base: str, entity: Entity | str) -> DataFrame:
    """Lag percentiles of a forked stream by hour of processing, from its summaries."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    summaries = spark.read.parquet(f"{output_base.rstrip('/')}/batch_summaries/{entity.name}")
    hour = F.date_trunc("hour", F.timestamp_millis("processing_ms"))
    return freshness_percentiles(summaries.withColumn("hour", hour), ["hour"])


def replay(
    spark: SparkSession,
    bronze_path: str,
    entity: Entity | str,
    output_base: str,
    profile: str = "record",
) -> dict[str, int]:
    """Run landed messages again through the current rules into a new output folder, to
    be checked and then put in place of the old one."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base = output_base.rstrip("/")
    run_id = str(uuid.uuid4())
    accepted, rejected = split_events(spark.read.parquet(bronze_path), entity, profile, run_id)
    return {
        "silver_changelog": write_table(
            accepted, f"{base}/silver_changelog/{entity.name}", entity.partition_by
        ),
        "errors": write_table(rejected, f"{base}/errors/{entity.name}"),
    }


def snapshot_of_messages(messages: DataFrame, entity: Entity, profile: str = "record") -> DataFrame:
    """Batch shortcut: messages to the current rows. Duplicates need no removal of their
    own here, the last of several equal changes is the same change; one shuffle serves."""
    return current_state(valid_rows(read_events(messages, entity, profile)), entity)


def audit_lake(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows and latest processing time per tier."""
    base = data_dir.rstrip("/")

    def tier(folder: str, column: str, names) -> DataFrame | None:
        found = [read_parquet(spark, f"{base}/{folder}/{name}") for name in names]
        frames = [
            df.select(F.col(column).cast("string").alias("stamp")) for df in found if df is not None
        ]
        result = None
        for frame in frames:
            result = frame if result is None else result.unionByName(frame)
        return result

    marts = ("daily_sales", "customer_lifetime_value", "product_performance", "payment_summary")
    errors = read_errors(spark, base).select(F.col("processing_timestamp").alias("stamp"))
    tiers = {
        "bronze": tier("bronze", "landed_at", ENTITIES),
        "silver": tier("silver", "ingestion_timestamp", ENTITIES),
        "gold": tier("gold", "calculated_at", marts),
        "errors": errors,
    }
    return tier_audit(tiers, {name: "stamp" for name in tiers})


def run_batch(
    spark: SparkSession,
    input_dir: str,
    data_dir: str,
    profile: str = "record",
    gate: bool = True,
    declaration: Mapping[str, Mapping] | None = None,
) -> dict:
    """The batch sequence: load and judge, gate on the share of rejects in what came in,
    build the marts, audit the result. Loading the same files again changes nothing."""
    base = data_dir.rstrip("/")
    loaded = _load_all(spark, input_dir, base, profile, declaration)
    verdicts = {t: found.verdicts for t, found in loaded.items() if found and found.verdicts}
    scores = score_counts(spark, verdicts)
    if gate:
        share_gate(scores, read_errors(spark, base))
    run_transformations(spark, f"{base}/silver", f"{base}/gold")
    return {
        "rows": _rows(loaded),
        "quality": scores.collect(),  # one row per table
        "tiers": audit_lake(spark, base).collect(),  # one row per tier
    }
