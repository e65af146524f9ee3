"""Ranks without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged


def top_with_dense_rank(
    df: DataFrame, value: str, tie_break: str, k: int, rank_name: str
) -> DataFrame:
    """The ``k`` greatest values with their dense rank over the whole frame.

    A rank among the top rows depends on those rows only, so the top-k runs first, one
    heap per task, and the window sees ``k`` rows.
    """
    order = [F.desc(value), F.asc(tie_break)]
    top = df.orderBy(*order).limit(k)
    ranked = top.withColumn(rank_name, F.dense_rank().over(Window.orderBy(F.desc(value))))
    return ranked.orderBy(*order)


def dense_rank_all(df: DataFrame, value: str, rank_name: str) -> DataFrame:
    """Dense rank by ``value`` descending for every row; a null value has no rank.

    ``Window.orderBy`` without partitions would sort all rows in one task. Here the
    distinct values are range-partitioned, ranked inside each range, and shifted by the
    number of values in higher ranges; there are as many ranges as shuffle partitions, so
    they grow with the cluster. Rows without a value stay out of the join, where they would
    all be one key.
    """
    held = df.filter(F.col(value).isNotNull())
    ranges = held.select(value).distinct().repartitionByRange(F.desc(value))
    # Written, so that every use sees the same ranges.
    placed = staged(ranges.withColumn("_range", F.spark_partition_id()), "rank-values")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_range").orderBy(F.desc(value))
    ranks = (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")  # one row per shuffle partition at most
        .select(value, (F.col("_offset") + F.col("_place")).alias(rank_name))
    )
    unranked = df.filter(F.col(value).isNull()).withColumn(rank_name, F.lit(None).cast("long"))
    ranked = held.join(ranks, value).select(*df.columns, F.col(rank_name).cast("long"))
    return ranked.unionByName(unranked)
