"""Upkeep: backfill of single days, compaction of small files, clustered layouts."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES, Entity
from tidemark.session import remove_path, scratch_dir
from tidemark.sinks.tables import refuse_stream_output, write_table
from tidemark.sources.tables import batch_numbers, compacted_upto, path_exists, segment_path

log = logging.getLogger(__name__)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``; all others stay."""
    refuse_stream_output(df.sparkSession, path)
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def backfill_day(df: DataFrame, path: str, day_column: str, day: str) -> None:
    """Recompute one day of a day-partitioned table. Rows of other days in ``df`` are not
    written, so a backfill can be repeated without touching its neighbours."""
    rows = df.filter(F.col(day_column) == F.lit(day).cast("date"))
    replace_partitions(rows, path, [day_column])


def compact_partition(
    spark: SparkSession, path: str, partition_by: Sequence[str], **values
) -> int:
    """Rewrite one partition into files of the advisory partition size; returns its rows.

    The rows go to a staging table first, because a table cannot be overwritten while it
    is read. A job that dies in between leaves the partition as it was, or a staging copy
    (its path is in the log) from which the overwrite can be repeated; it goes when the
    overwrite is done.
    """
    partition = spark.read.parquet(path)
    for name, value in values.items():
        partition = partition.filter(F.col(name) == F.lit(value))
    staging = scratch_dir(spark, "compaction")
    log.info("compacting %s %s by way of %s", path, values, staging)
    rows = write_table(partition.hint("rebalance"), staging)
    if rows:
        replace_partitions(spark.read.parquet(staging), path, partition_by)
    remove_path(spark, staging)
    return rows


def compact_changelog(
    spark: SparkSession, path: str, target: str, partition_by: Sequence[str] = ()
) -> int:
    """A streaming sink's table as a new folder of few large files; returns its rows. The
    sink's own folder stays as it is, for its file list belongs to the stream; readers are
    pointed to ``target`` once it is complete."""
    return write_table(spark.read.parquet(path), target, partition_by)


def compact_batches(spark: SparkSession, output_base: str, entity: Entity | str) -> dict[str, int]:
    """Put the closed micro-batches of a forked stream's change log together in few files,
    while it goes on: all but the last of every stream, for only that one can be run again.
    Returns the last batch compacted by stream.

    A segment counts for readers once its write is complete; until then, and for the batches
    after it, they take the folders of the batches. Every batch is in one of the two.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base = output_base.rstrip("/")
    done, written = compacted_upto(spark, base, entity.name), {}
    for stream, numbers in batch_numbers(spark, base, entity.name).items():
        closed = [n for n in sorted(numbers)[:-1] if n > done.get(stream, -1)]
        if len(closed) < 2:
            continue
        rows = spark.read.parquet(f"{base}/silver_changelog/{entity.name}").filter(
            (F.col("stream") == stream) & F.col("batch_id").between(closed[0], closed[-1])
        )
        path = segment_path(base, entity.name, stream, closed[-1])
        write_table(rows.drop("stream"), path, entity.partition_by)
        written[stream] = closed[-1]
    return written


def remove_compacted(spark: SparkSession, output_base: str, entity: Entity | str) -> int:
    """Delete the folders of micro-batches that segments hold; returns how many. Readers that
    started before the segments were complete must have ended."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    base, removed = output_base.rstrip("/"), 0
    done = compacted_upto(spark, base, entity.name)
    for stream, numbers in batch_numbers(spark, base, entity.name).items():
        for number in numbers:
            path = f"{base}/silver_changelog/{entity.name}/stream={stream}/batch_id={number}"
            if number <= done.get(stream, -1) and path_exists(spark, path):
                remove_path(spark, path)
                removed += 1
    return removed


def z_order(df: DataFrame, columns: Sequence[str], bits: int = 10) -> Column:
    """A number that is near where all columns are near: the bits of each column's place
    between its least and its greatest value, interleaved. Numbers, dates and timestamps;
    nulls come first."""
    kinds = dict(df.dtypes)

    def number(name: str) -> Column:
        column = F.col(name)
        if kinds[name] == "date":
            column = F.unix_date(column)
        elif kinds[name].startswith("timestamp"):
            column = F.unix_micros(column.cast("timestamp"))
        return column.cast("double")

    edges = df.agg(
        *[F.min(number(name)).alias(f"low{i}") for i, name in enumerate(columns)],
        *[F.max(number(name)).alias(f"high{i}") for i, name in enumerate(columns)],
    ).first()
    z = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        low, high = edges[f"low{i}"], edges[f"high{i}"]
        if low is None or low == high:
            continue
        share = (number(name) - low) / (high - low)
        place = F.coalesce(F.floor(share * ((1 << bits) - 1)).cast("long"), F.lit(0).cast("long"))
        for k in range(bits):
            bit = F.shiftright(place, k).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, k * len(columns) + i))
    return z


def write_clustered(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Write a table so that rows near in ``columns`` share files and row groups: their
    statistics let a reader skip the rest, by any of the columns, with as few files as an
    unclustered table has. Returns its rows."""
    order = z_order(df, columns)
    ranged = df.withColumn("_z", order).repartitionByRange("_z").sortWithinPartitions("_z", *columns)
    return write_table(ranged.drop("_z"), path)
