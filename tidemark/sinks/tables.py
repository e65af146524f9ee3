"""Batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import path_exists


def refuse_stream_output(spark: SparkSession, path: str) -> None:
    """Stop a batch write into the folder of a streaming sink: readers follow the sink's
    own file list and would miss the new files or look for deleted ones."""
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a streaming query; write to another folder")


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Write Parquet and return the number of rows, counted by the write job itself.

    Partition columns apply only if the frame has all of them. Rows are then rebalanced
    on those columns, so a partition is written by a few tasks (more for a large one)
    instead of every task leaving a small file in every partition.
    """
    refuse_stream_output(df.sparkSession, path)
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    columns = list(partition_by)
    if columns and all(name in df.columns for name in columns):
        writer = rows.hint("rebalance", *columns).write.partitionBy(*columns)
    else:
        writer = rows.write
    writer.mode(mode).parquet(path)
    return counted.get["rows"]


def write_mart(df: DataFrame, gold_base: str, name: str) -> int:
    """Replace a gold mart."""
    return write_table(df, f"{gold_base.rstrip('/')}/{name}")


def export_table(df: DataFrame, output_dir: str, table: str) -> dict[str, str]:
    """Export a table twice, as CSV with header and as Parquet."""
    path = f"{output_dir.rstrip('/')}/{table}.parquet"
    df.write.mode("overwrite").parquet(path)
    return {"csv": export_csv(df, output_dir, table), "parquet": path}


def export_csv(df: DataFrame, output_dir: str, table: str) -> str:
    """Export a table as CSV with header; the path. Quotes are doubled and blanks kept, so
    that any CSV reader gets the same text."""
    path = f"{output_dir.rstrip('/')}/{table}.csv"
    options = {
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    df.write.mode("overwrite").options(**options).csv(path)
    return path


def replace_rejects(errors: DataFrame, data_dir: str, table: str) -> int:
    """The dead letters of one table's batch input, in place of those of the run before:
    loading the same files again changes nothing."""
    return write_table(errors, f"{data_dir.rstrip('/')}/errors/batch_{table}")


def append_incidents(errors: DataFrame, data_dir: str) -> int:
    """Add dead-letter records found outside the streams."""
    return write_table(errors, f"{data_dir.rstrip('/')}/errors/incidents", mode="append")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below ``path``; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]


def compare_formats(df: DataFrame, output_dir: str, table: str) -> dict[str, float]:
    """Bytes of the CSV and the Snappy Parquet export of one table, and their ratio."""
    paths = export_table(df, output_dir, table)
    csv_bytes = stored_bytes(df.sparkSession, paths["csv"])
    parquet_bytes = stored_bytes(df.sparkSession, paths["parquet"])
    return {
        "csv_bytes": csv_bytes,
        "parquet_bytes": parquet_bytes,
        "size_ratio": csv_bytes / parquet_bytes if parquet_bytes else float("nan"),
    }
