"""One streaming query per entity that feeds every table behind it, each exactly once.

A micro-batch is parsed, judged and freed of duplicates once; then its accepted rows go to
``silver_changelog/<table>``, its rejected rows to ``errors/<table>``, and on demand its
changes into the latest state ``state/<table>``. Spark runs a batch again if the query died
before noting it as done, with the same input. So every output is named by the batch: files
lie in a folder of the stream and the batch, which a repeated batch replaces, and the state is
a keyed table whose merges change nothing the second time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.deadletter import dead_letters
from tidemark.operators.dedup import distinct_events
from tidemark.operators.envelope import read_events
from tidemark.operators.lateness import lag_columns
from tidemark.operators.state import change_columns, live_rows, operation_rank, rejected_deletes
from tidemark.schemas import ENTITIES, Entity
from tidemark.sinks.keyed import KeyedTable, Merged
from tidemark.sinks.tables import refuse_stream_output
from tidemark.streaming.identities import identity_table, unseen
from tidemark.streaming.pipelines import (
    DEFAULT_DELAY,
    changelog_rows,
    distinct_judged,
    new_run,
    setting,
    shuffle_partitions,
)

Follow = Callable[[Merged, str], None]


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name for what runs on a checkpoint: the same after a restart, another for a new
    checkpoint, whose batches count from 0 again."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"]
    return "s" + json.loads(text)["id"].replace("-", "")[:12]


def batch_folder(path: str, stream: str, batch_id: int) -> str:
    return f"{path}/stream={stream}/batch_id={batch_id}"


def write_batch(
    rows: DataFrame, path: str, stream: str, batch_id: int, partition_by: tuple[str, ...] = ()
) -> None:
    """The rows of one micro-batch, in place of what an attempt before left of it."""
    refuse_stream_output(rows.sparkSession, path)
    writer = rows.hint("rebalance", *partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(batch_folder(path, stream, batch_id))


def summary(judged: DataFrame) -> DataFrame:
    """One row about a micro-batch, for audits that need not read its events: the greatest
    event time, and the lags as a sketch."""
    events = judged.select("event_ts_ms", F.unix_millis("processing_time").alias("processing_ms"))
    times = (
        F.count("*").alias("all_events"),
        F.max("event_ts_ms").alias("greatest_event_ms"),
        F.max("processing_ms").alias("processing_ms"),
    )
    return events.agg(*times, *lag_columns("event_ts_ms", "processing_ms"))


def state_table(spark: SparkSession, output_base: str, entity: Entity | str) -> KeyedTable:
    """The last change of every key, deletes as tombstones."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return KeyedTable(spark, f"{output_base.rstrip('/')}/state/{entity.name}", entity.key)


def change_order(row: Column) -> list[Column]:
    """Later changes are greater: by event time, log position, operation."""
    return [row["event_ts_ms"], row["log_position"], operation_rank(row["operation"])]


def advance(
    table: KeyedTable,
    accepted: DataFrame,
    rejected: DataFrame,
    entity: Entity,
    mark: dict | None = None,
    forget_before_ms: int | None = None,
) -> Merged:
    """Take the changes of a batch into the latest state. A change older than the stored one
    changes nothing, whenever it arrives; deletes whose old row was rejected still delete.
    Tombstones older than ``forget_before_ms`` go when their file is written again; nothing
    older may arrive after that."""
    changes = change_columns(accepted, entity).unionByName(rejected_deletes(rejected, entity))
    old = None
    if forget_before_ms is not None:
        old = (F.lower("operation") == "d") & (F.col("event_ts_ms") < forget_before_ms)
    return table.advance(changes, change_order, mark=mark, expired=old)


def latest_rows(spark: SparkSession, output_base: str, entity: Entity | str) -> DataFrame:
    """The rows that exist now, after the last batch that was taken in."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return live_rows(state_table(spark, output_base, entity).read(), entity)


def process_stream_fork(
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
    keep_state: bool = False,
    follow: Follow | None = None,
    exact: bool = False,
) -> StreamingQuery:
    """Start the one query of an entity: source, parsing and duplicate state exist once.

    With ``keep_state`` the latest state is kept as well; ``follow`` is then called with the
    merge of every batch and the batch's name, such as to move marts on. It may be called
    twice with the same name and must then replace what it did.

    With ``exact`` copies are found at any distance, after restarts and in replays with a new
    checkpoint too: identities are kept in a table below ``identities/`` instead of in the
    query's state, and ``delay`` has no meaning.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    run = run_id or new_run(spark, checkpoint_base, entity.name)
    out, checkpoint = output_base.rstrip("/"), f"{checkpoint_base.rstrip('/')}/{entity.name}_fork"
    if exact:
        judged = read_events(messages, entity, profile, declaration)
    else:
        judged = distinct_judged(messages, entity, profile, delay, declaration)
    table = state_table(spark, out, entity)

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = stream_name(spark, checkpoint)
        read = None
        if exact:
            # Asked twice: for its identities, and for the events that are new.
            read = distinct_events(batch, entity.key).persist()
        held = batch
        try:
            if exact:
                known, mark = identity_table(spark, out, entity), {stream: batch_id}
                held = unseen(known, read, entity.key, mark).drop("message_key")
            held = held.persist()
            accepted = changelog_rows(held, entity, run)
            rejected = dead_letters(held, entity, run, F.col("processing_time"))
            write_batch(
                accepted, f"{out}/silver_changelog/{entity.name}", stream, batch_id, entity.partition_by
            )
            write_batch(rejected, f"{out}/errors/{entity.name}", stream, batch_id)
            write_batch(summary(held), f"{out}/batch_summaries/{entity.name}", stream, batch_id)
            if keep_state:
                merged = advance(table, accepted, rejected, entity, {stream: batch_id})
                if follow:
                    follow(merged, f"{stream}-{batch_id}")
        finally:
            held.unpersist()
            if read is not None:
                read.unpersist()

    writer = (
        judged.writeStream.queryName(f"{entity.name}_fork_{run}")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(store)
    )
    # Batches without events would only forget old state earlier.
    idle = setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")
    with shuffle_partitions(spark, state_partitions), idle:
        return writer.start()
