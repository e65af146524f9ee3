"""Reading the tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would: the
    functions that run inside tasks import it there. They get batches of BATCH_BYTES at
    most, which bounds what a worker holds at a time."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one. Operators start from
    this, so that no further column of a table can clash with theirs."""
    ship(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))


def text_or_empty() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: later jobs start from
    files that every executor reaches, whichever executor wrote them."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column; case does not count."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staying(documents: DataFrame, verdicts: DataFrame, mark: Column, marked: str) -> DataFrame:
    """The rows of ``documents``, with all their columns, that ``verdicts`` keeps. A verdict
    names rows by ``doc_id`` and ``marked``, the value of ``mark`` over their columns; it
    has ``kept`` and ``repeats``, the rows it stands for, of which one stays."""
    own, value, rows_of = (unused(documents, n) for n in ("_id", "_marked", "_repeats"))
    stays = verdicts.filter("kept").select(
        F.col("doc_id").alias(own), F.col(marked).alias(value), F.col("repeats").alias(rows_of)
    )
    stays = written(stays, "staying")
    same = (mark == F.col(value)) & F.col("doc_id").cast("long").eqNullSafe(F.col(own))
    rows = documents.join(stays, same)
    once = rows.filter(F.col(rows_of) == 1)
    repeated = F.col(rows_of) > 1
    if stays.filter(repeated).limit(1).count():
        once = once.unionByName(rows.filter(repeated).dropDuplicates([own, value]))
    return once.select(*[F.col(f"`{name}`") for name in documents.columns])
