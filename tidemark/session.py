"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Shuffle partitions are left to the cluster and to
# adaptive execution; time zone and ANSI mode decide results and are fixed here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Recording the call site of every column operation makes building plans much slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
}

# State of streaming deduplication lives in RocksDB, not on the executor heap.
STREAMING_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the keys of the state would look up every key once more.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(
    app_name: str = "tidemark",
    streaming: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine's settings. Object-store credentials and the like come
    from the deployment (``spark.hadoop.fs.*``), or through ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**SETTINGS, **(STREAMING_SETTINGS if streaming else {}), **(extra or {})}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Set the result-deciding settings on a session somebody else built; for streams also
    where they keep their state."""
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(name, SETTINGS[name])
    for name, value in STREAMING_SETTINGS.items() if streaming else ():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder the cluster names
    in ``spark.checkpoint.dir``. Only a local session without that setting may use the
    machine's temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back: what several branches
    need is computed once, and a lost executor repeats none of it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder a job made for itself, on whatever file system it is."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
