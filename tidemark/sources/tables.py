"""Batch inputs: files, lake tables and the views reports read."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import ENTITIES, ERRORS, Entity

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def _or_none(spark: SparkSession, path: str, read) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """A Parquet table, or None if nothing is there. ``merge_schema`` unites the columns
    of files written before and after a column was added."""
    return _or_none(
        spark, path, lambda: spark.read.option("mergeSchema", merge_schema).parquet(path)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A CSV table with a header, columns typed by name.

    Only the header is read ahead. Known columns take the type of ``schema``, a cell that
    does not fit becomes null, and other columns stay text; nothing depends on the order
    of columns, and the data is not scanned an extra time to guess types.
    """
    df = _or_none(spark, path, lambda: spark.read.options(header="true", escape='"').csv(path))
    if df is None or schema is None:
        return df
    types = {field.name: field.dataType for field in schema}

    def typed(name: str) -> Column:
        column = F.col(f"`{name}`")
        return column.try_cast(types[name]).alias(name) if name in types else column

    return df.select(*[typed(name) for name in df.columns])


def read_source(spark: SparkSession, input_dir: str, table: str) -> DataFrame | None:
    """``<table>.parquet``, else ``<table>.csv``, else None with a warning."""
    base = f"{input_dir.rstrip('/')}/{table}"
    df = read_parquet(spark, f"{base}.parquet")
    if df is None:
        schema = ENTITIES[table].payload if table in ENTITIES else None
        df = read_csv(spark, f"{base}.csv", schema)
    if df is None:
        log.warning("no source data for %s in %s", table, input_dir)
    return df


def load_silver(spark: SparkSession, silver_base: str) -> dict[str, DataFrame]:
    """The five silver snapshots."""
    base = silver_base.rstrip("/")
    return {name: spark.read.parquet(f"{base}/{name}") for name in ENTITIES}


def read_partition(spark: SparkSession, path: str, **values) -> DataFrame:
    """One partition of a partitioned table. The condition on the partition columns
    prunes directories while planning, and the columns stay in the result."""
    df = spark.read.parquet(path)
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def empty_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ERRORS)


def _entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Name and whether it is a folder, of what is in a folder; hidden names left out."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        return []
    found = [(e.getPath().getName(), e.isDirectory()) for e in files.listStatus(hadoop_path)]
    return sorted((name, folder) for name, folder in found if name[0] not in "._")


def read_judged(
    spark: SparkSession, output_base: str, entity: Entity | str, status: str | None = None
) -> DataFrame | None:
    """Events stored by the single-query stream, one side or both; None if there are
    none. A status prunes the other side's folders."""
    name = entity if isinstance(entity, str) else entity.name
    df = read_parquet(spark, f"{output_base.rstrip('/')}/judged_changelog/{name}")
    return df if df is None or status is None else df.filter(F.col("validation_status") == status)


def judged_errors(spark: SparkSession, output_base: str, entity: Entity | str) -> DataFrame | None:
    """The rejected side of the single-query stream in the dead-letter shape."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    rejected = read_judged(spark, output_base, entity, "INVALID")
    if rejected is None:
        return None
    return rejected.select(
        "source_table",
        F.col(entity.key).cast("string").alias("record_id"),
        F.lower("operation").alias("operation"),
        F.coalesce("event_ts_ms", F.unix_millis("processing_time")).alias("event_timestamp"),
        "processing_timestamp",
        "pipeline_run_id",
        "validation_status",
        "validation_reason",
        "raw_payload",
    )


def batch_numbers(spark: SparkSession, base: str, table: str) -> dict[str, list[int]]:
    """The micro-batches whose folders are in a forked stream's change log, by stream."""
    root = f"{base}/silver_changelog/{table}"
    streams = [name for name, folder in _entries(spark, root) if folder and name.startswith("stream=")]
    return {
        stream[7:]: [
            int(name[9:]) for name, _ in _entries(spark, f"{root}/{stream}") if name.startswith("batch_id=")
        ]
        for stream in streams
    }


def segment_path(base: str, table: str, stream: str, upto: int) -> str:
    return f"{base}/compacted/{table}/stream={stream}/upto={upto}"


def _segments(spark: SparkSession, base: str, table: str) -> dict[str, list[int]]:
    """Segments of micro-batches by stream, those whose write is complete."""
    root = f"{base}/compacted/{table}"
    found: dict[str, list[int]] = {}
    for stream, _ in _entries(spark, root):
        for name, _ in _entries(spark, f"{root}/{stream}"):
            if name.startswith("upto=") and path_exists(spark, f"{root}/{stream}/{name}/_SUCCESS"):
                found.setdefault(stream[7:], []).append(int(name[5:]))
    return found


def compacted_upto(spark: SparkSession, base: str, table: str) -> dict[str, int]:
    """The last micro-batch in a segment, by stream."""
    return {stream: max(uptos) for stream, uptos in _segments(spark, base, table).items()}


def _changelog(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The accepted changes of a table: whole segments, and the batches after them."""
    stored = read_parquet(spark, f"{base}/silver_changelog/{table}")
    segments = _segments(spark, base, table)
    if not segments:
        return stored
    paths = [segment_path(base, table, s, upto) for s, uptos in segments.items() for upto in uptos]
    root = f"{base}/compacted/{table}"
    compacted = spark.read.option("basePath", root).parquet(*paths).drop("upto")
    if stored is None:
        return compacted
    tail = stored
    for stream, uptos in segments.items():
        tail = tail.filter((F.col("stream") != stream) | (F.col("batch_id") > max(uptos)))
    return compacted.unionByName(tail)


def read_changes(spark: SparkSession, output_base: str, entity: Entity) -> DataFrame | None:
    """Accepted changes from whichever form of the stream wrote them, or from both."""
    base = output_base.rstrip("/")
    two = _changelog(spark, base, entity.name)
    one = read_judged(spark, base, entity, "VALID")
    if one is None or two is None:
        return two if one is None else one
    return two.unionByName(one, allowMissingColumns=True)


def read_entity_errors(spark: SparkSession, output_base: str, entity: Entity) -> DataFrame | None:
    """Dead letters of one entity's streams, of either form."""
    two = read_parquet(spark, f"{output_base.rstrip('/')}/errors/{entity.name}")
    one = judged_errors(spark, output_base, entity)
    if one is None or two is None:
        return two if one is None else one
    return two.unionByName(one, allowMissingColumns=True)


def read_errors(spark: SparkSession, data_dir: str) -> DataFrame:
    """The dead-letter table; typed and empty if there is none.

    It is whatever lies below ``errors``: a folder per entity or per batch input, and
    files put there directly; and the rejected side of single-query streams. Each folder is
    read on its own, so that the file list of a streaming sink counts.
    """
    base = f"{data_dir.rstrip('/')}/errors"
    entries = _entries(spark, base)
    found = [read_parquet(spark, f"{base}/{name}") for name, folder in entries if folder]
    loose = [f"{base}/{name}" for name, folder in entries if not folder and name.endswith(".parquet")]
    if loose:
        found.append(spark.read.parquet(*loose))
    found += [judged_errors(spark, data_dir, entity) for entity in ENTITIES.values()]
    result = empty_errors(spark)
    for df in found:
        if df is not None:
            result = result.unionByName(df, allowMissingColumns=True)
    return result.select(ERRORS.fieldNames())


def register_views(spark: SparkSession, data_dir: str) -> dict[str, str]:
    """Temporary views ``<table>_source`` and ``errors_source``.

    A table comes from its silver snapshot, else from the batch Parquet file, else from
    the batch CSV file; a table found nowhere gets no view. Returns what was found where.
    """
    base = data_dir.rstrip("/")
    origins: dict[str, str] = {}
    for name, entity in ENTITIES.items():
        candidates = (
            (f"{base}/silver/{name}", lambda p: read_parquet(spark, p)),
            (f"{base}/batch/{name}.parquet", lambda p: read_parquet(spark, p)),
            (f"{base}/batch/{name}.csv", lambda p, s=entity.payload: read_csv(spark, p, s)),
        )
        for path, read in candidates:
            df = read(path)
            if df is not None:
                df.createOrReplaceTempView(f"{name}_source")
                origins[name] = path
                break
        else:
            log.warning("no data for view %s_source", name)
    read_errors(spark, base).createOrReplaceTempView("errors_source")
    return origins
