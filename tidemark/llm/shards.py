"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; rank r of n becomes the
fraction (2r - 1) / 2n. Sorted by fraction, every stretch of rows has the mixture of the
whole, so equal cuts give shards of equal mixture, with row counts at most one apart.

No rank is taken over a whole source, nor over the whole table: rows fall into narrow
bands of the hash (of the fraction), bands are counted, counts are summed up, and rows
are ranked within their band. A source with a third of all rows has a third of the bands.
Only ids, sizes and checksums move, no texts.

The law is by rows, so copies of a text are spread like all others; a group larger than a
shard could not stay together. Cases: a null text has size 1 and checksum 0; a null source
is a source of its own; rows with equal ids are ordered by size and checksum, identical
rows take consecutive slots; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import partitions, text_or_empty, written

BAND_ROWS = 100_000


def _bands(n: Column, rows_per_band: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(rows_per_band))).cast("long")


def _ranked(df: DataFrame, group: list[str], order: list, counts: DataFrame) -> DataFrame:
    """``df`` with ``place``: its place within ``group`` from 1 on, by ``band`` and
    ``order``. ``counts`` has the rows of each band."""
    before = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    offsets = counts.withColumn("upto", F.sum("rows").over(before.orderBy("band"))).select(
        *group, "band", (F.col("upto") - F.col("rows")).alias("before")
    )
    within = Window.partitionBy(*group, "band").orderBy(*order)
    return (
        df.join(offsets, [*group, "band"])
        .withColumn("place", F.col("before") + F.row_number().over(within))
        .drop("before", "band")
    )


def _counted(rows: DataFrame, sources: DataFrame, hot: int) -> DataFrame:
    """``rows`` with the number ``n`` of their source. Sources of ``hot`` rows or more, of which
    there are at most so many as rows by ``hot``, are sent to the rows; only rows of smaller
    sources move."""
    large = F.broadcast(sources.filter(F.col("n") >= hot))
    found = rows.join(large, "source", "left")
    small = rows.join(large, "source", "left_anti").join(
        sources.filter(F.col("n") < hot).hint("shuffle_hash"), "source"
    )
    return found.filter(F.col("n").isNotNull()).unionByName(small)


def interleave(documents: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, source, shard, slot``."""
    spark = documents.sparkSession
    text = text_or_empty()
    rows = documents.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text).alias("draw"),
    )
    # Texts are read once; every later pass reads this narrow table.
    rows = written(rows, "shard-rows")
    sources = written(rows.groupBy("source").agg(F.count("*").alias("n")), "sources")
    total = rows.count()
    per_band = max(1, min(BAND_ROWS, total // (16 * partitions(spark))))

    # The upper 53 bits of the draw as a fraction, cut into the bands of the source.
    share = F.shiftrightunsigned("draw", 11).cast("double") / F.lit(float(1 << 53))
    banded = _counted(rows, sources, per_band).withColumn(
        "band", F.floor(share * _bands(F.col("n"), per_band)).cast("long")
    )
    counts = banded.groupBy("source", "band").agg(F.count("*").alias("rows"))
    order = [F.shiftrightunsigned("draw", 11), "draw", "doc_id", "size", "text_crc32"]
    ranked = _ranked(banded, ["source"], order, counts).withColumn(
        "fraction", (2 * F.col("place") - 1) / (2 * F.col("n")).cast("double")
    )
    ranked = written(ranked.drop("place", "n"), "shard-ranks")

    bands = max(1, total // per_band)
    banded = ranked.withColumn("band", F.floor(F.col("fraction") * bands).cast("long"))
    counts = banded.groupBy("band").agg(F.count("*").alias("rows"))
    order = ["fraction", "source", "draw", "doc_id", "size", "text_crc32"]
    placed = _ranked(banded, [], order, counts)

    # Cut i starts at row ceil(i * total / shards).
    position = F.col("place") - 1
    shard = F.expr(f"((place - 1) * {shards}L) div {max(1, total)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr("if(source = '', null, substring(source, 2))").alias("source"),
        F.col("shard").cast("int").alias("shard"),
        (position - first).cast("long").alias("slot"),
    )
