"""Change streams to silver change logs and dead letters.

One pipeline serves every entity. The transformation is the batch one
(:mod:`tidemark.operators.envelope`); only the duplicate removal keeps state.

Streaming output goes to ``silver_changelog/<table>``, apart from the snapshots in
``silver/<table>``: a streaming sink tracks its own files, and batch writers in the same
folder would hide or destroy them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.temporal import iso_utc, now_ms
from tidemark.operators.deadletter import dead_letters, for_topic
from tidemark.operators.dedup import distinct_events, distinct_events_stream
from tidemark.operators.envelope import message_text, read_events, with_business_day
from tidemark.operators.rules import valid_rows
from tidemark.schemas import ENTITIES, Entity

DEFAULT_DELAY = "10 minutes"


def changelog_rows(judged: DataFrame, entity: Entity, run_id: str) -> DataFrame:
    """Accepted events in their stored shape, with provenance."""
    return with_business_day(valid_rows(judged), entity).select(
        *entity.columns,
        *([f"{entity.date_column}_dt"] if entity.date_column else []),
        "operation",
        "event_ts_ms",
        "log_position",
        "processing_time",
        "validation_status",
        "validation_reason",
        F.lit(entity.name).alias("source_table"),
        F.coalesce("event_ts_ms", now_ms()).alias("event_timestamp"),
        iso_utc(F.col("processing_time")).alias("processing_timestamp"),
        F.lit(run_id).alias("pipeline_run_id"),
    )


def distinct_judged(
    messages: DataFrame,
    entity: Entity,
    profile: str,
    delay: str | None = DEFAULT_DELAY,
    declaration: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Judged events without duplicates, for a stream or a batch of messages."""
    judged = read_events(messages, entity, profile, declaration)
    if messages.isStreaming:
        once = distinct_events_stream(judged, entity.key, delay)
    else:
        once = distinct_events(judged, entity.key)
    return once.drop("message_key")


def split_events(
    messages: DataFrame,
    entity: Entity,
    profile: str = "record",
    run_id: str = "adhoc",
    delay: str | None = DEFAULT_DELAY,
    stamp: Column | None = None,
    declaration: Mapping[str, Mapping] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(accepted change-log rows, dead letters)`` of a stream or batch of messages.
    Every distinct event is in exactly one of the two, however late it arrives."""
    judged = distinct_judged(messages, entity, profile, delay, declaration)
    time = stamp if stamp is not None else F.col("processing_time")
    return changelog_rows(judged, entity, run_id), dead_letters(judged, entity, run_id, time)


def new_run(spark: SparkSession, checkpoint_base: str, table: str) -> str:
    """The id of one start of a stream, noted beside its checkpoints."""
    run_id = f"{table}-{uuid.uuid4()}"
    started = spark.range(1).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(table).alias("source_table"),
        F.current_timestamp().alias("started_at"),
    )
    started.write.mode("append").parquet(f"{checkpoint_base.rstrip('/')}/runs")
    return run_id


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None,
    partition_by: tuple[str, ...] = (),
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffle_partitions(df.sparkSession, state_partitions):
        return writer.start()


@contextmanager
def setting(spark: SparkSession, name: str, value: object):
    """A query copies the session's settings when it starts and keeps them; batch jobs of the
    session go on with the usual value. None leaves it."""
    usual = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if value is not None and usual is None:
            spark.conf.unset(name)
        elif value is not None:
            spark.conf.set(name, usual)


def shuffle_partitions(spark: SparkSession, count: int | None):
    """The number of state partitions, which a query keeps for life."""
    return setting(spark, "spark.sql.shuffle.partitions", count)


def process_stream(
    spark: SparkSession,
    messages: DataFrame,
    entity: Entity | str,
    output_base: str,
    checkpoint_base: str,
    profile: str = "record",
    delay: str | None = DEFAULT_DELAY,
    trigger: dict | None = None,
    run_id: str | None = None,
    state_partitions: int | None = None,
    declaration: Mapping[str, Mapping] | None = None,
) -> list[StreamingQuery]:
    """Start the silver and the dead-letter query of one entity.

    The two queries have their own checkpoints and progress independently; each reads the
    source and keeps its own duplicate state. :func:`process_stream_once` shares both.
    ``state_partitions`` fixes over how many tasks the duplicate state is spread, by
    default the session's shuffle partitions. Without a ``run_id`` every start has a new
    one.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    run = run_id or new_run(spark, checkpoint_base, entity.name)
    accepted, rejected = split_events(
        messages, entity, profile, run, delay, declaration=declaration
    )
    out, state = output_base.rstrip("/"), checkpoint_base.rstrip("/")
    return [
        start_table(
            accepted,
            f"{out}/silver_changelog/{entity.name}",
            f"{state}/{entity.name}_silver",
            f"{entity.name}_silver_{run}",
            entity.partition_by,
            trigger,
            state_partitions,
        ),
        start_table(
            rejected,
            f"{out}/errors/{entity.name}",
            f"{state}/{entity.name}_errors",
            f"{entity.name}_errors_{run}",
            (),
            trigger,
            state_partitions,
        ),
    ]


def process_stream_once(
    spark: SparkSession,
    messages: DataFrame,
    entity: Entity | str,
    output_base: str,
    checkpoint_base: str,
    profile: str = "record",
    delay: str | None = DEFAULT_DELAY,
    trigger: dict | None = None,
    run_id: str | None = None,
    state_partitions: int | None = None,
    declaration: Mapping[str, Mapping] | None = None,
) -> StreamingQuery:
    """The same split with one query: source, parsing and duplicate state exist once.

    Accepted and rejected events share the table ``judged_changelog/<table>``, partitioned
    by ``validation_status``; reading one side prunes the other side's folders. Snapshots,
    views, errors and audits read this table like the two of :func:`process_stream`. Use it
    when the second read of the topic or the second copy of the state is what limits the
    job.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    run = run_id or new_run(spark, checkpoint_base, entity.name)
    judged = distinct_judged(messages, entity, profile, delay, declaration)
    rows = with_business_day(judged, entity).withColumns(
        {
            "source_table": F.lit(entity.name),
            "event_timestamp": F.coalesce("event_ts_ms", now_ms()),
            "pipeline_run_id": F.lit(run),
            "processing_timestamp": iso_utc(F.col("processing_time")),
        }
    )
    return start_table(
        rows,
        f"{output_base.rstrip('/')}/judged_changelog/{entity.name}",
        f"{checkpoint_base.rstrip('/')}/{entity.name}_judged",
        f"{entity.name}_judged_{run}",
        ("validation_status", *entity.partition_by),
        trigger,
        state_partitions,
    )


def process_orders_stream(spark, messages, output_base, checkpoint_base, **options):
    """Orders: silver partitioned by status."""
    return process_stream(spark, messages, "orders", output_base, checkpoint_base, **options)


def process_customer_stream(spark, messages, output_base, checkpoint_base, **options):
    """Customers: silver partitioned by state."""
    return process_stream(spark, messages, "customers", output_base, checkpoint_base, **options)


def process_payment_stream(spark, messages, output_base, checkpoint_base, **options):
    """Payments: silver partitioned by method."""
    return process_stream(spark, messages, "payments", output_base, checkpoint_base, **options)


def process_product_stream(spark, messages, output_base, checkpoint_base, **options):
    """Products: silver partitioned by category."""
    return process_stream(spark, messages, "products", output_base, checkpoint_base, **options)


def process_order_item_stream(spark, messages, output_base, checkpoint_base, **options):
    """Order items: no rules, silver without partitions."""
    return process_stream(spark, messages, "order_items", output_base, checkpoint_base, **options)


def land_messages(
    messages: DataFrame, bronze_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep every message as it arrived, the source of replays."""
    text = message_text(messages).select(
        F.col("message_key").alias("key"),
        F.col("raw_payload").alias("value"),
        F.current_timestamp().alias("landed_at"),
    )
    return start_table(text, bronze_path, checkpoint, None, (), trigger)


def publish_errors(
    errors: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send dead letters to a topic. Needs the Kafka connector on the class path."""
    return (
        for_topic(errors)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended. If one fails, the others are stopped and its
    error is raised, so a dead query never goes unseen behind a living one."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)  # raises the query's error
        for query in queries:
            query.awaitTermination(1)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
