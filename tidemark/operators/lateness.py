"""Late events and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

_DAY_MS = 86_400_000


def late_events(
    df: DataFrame,
    event_ms: str,
    arrival_ms: str,
    delay_ms: int = 600_000,
    batch_ms: int = 300_000,
) -> DataFrame:
    """Events a watermark of ``delay_ms`` would drop, with the watermark they missed.

    Arrivals are grouped to batches of ``batch_ms``. As in a stream, the watermark of a
    batch is the greatest event time of all earlier batches minus the delay, and an event
    exactly at the watermark is late. The greatest times per batch are written out, so the
    events are read twice in all: for them, and to be compared. The running maximum is
    taken inside each day and over the days, so no window spans all batches.
    """
    batch = F.floor(F.col(arrival_ms) / F.lit(batch_ms)).cast("long")
    placed = df.withColumn("_batch", batch)
    batches = (
        placed.groupBy("_batch")
        .agg(F.max(event_ms).alias("_max"))
        .withColumn("_day", F.floor(F.col("_batch") * F.lit(batch_ms) / F.lit(_DAY_MS)))
    )
    batches = staged(batches, "arrival-batches")
    earlier = (Window.unboundedPreceding, -1)
    days = batches.groupBy("_day").agg(F.max("_max").alias("_day_max"))
    before_day = days.select(
        "_day", F.max("_day_max").over(Window.orderBy("_day").rowsBetween(*earlier)).alias("_carry")
    )
    in_day = Window.partitionBy("_day").orderBy("_batch").rowsBetween(*earlier)
    marks = (
        batches.withColumn("_seen", F.max("_max").over(in_day))
        .join(before_day, "_day")
        .select(
            "_batch",
            (F.greatest("_seen", "_carry") - F.lit(delay_ms)).alias("watermark_ms"),
        )
    )
    return (
        placed.join(marks, "_batch")
        .filter(F.col(event_ms) <= F.col("watermark_ms"))
        .drop("_batch")
    )


def missing_events(landed: DataFrame, stored: DataFrame, identity: list[str]) -> DataFrame:
    """Distinct landed events that no sink holds: what a bounded stream left out."""
    keys = landed.select(*identity).distinct()
    known = stored.select(*[F.col(n).alias(f"_{n}") for n in identity]).distinct()
    same: Column | None = None
    for name in identity:
        condition = F.col(name).eqNullSafe(F.col(f"_{name}"))
        same = condition if same is None else same & condition
    return keys.join(known, same, "left_anti")


def freshness(
    df: DataFrame, event_ms: str, processing_ms: str, by: list[str], sla_seconds: float = 30.0
) -> DataFrame:
    """Lag between event and processing time per group, and events beyond the service
    level."""
    lag = (F.col(processing_ms) - F.col(event_ms)) / F.lit(1000.0)
    return df.groupBy(*by).agg(
        F.count("*").alias("event_count"),
        F.max(lag).alias("max_lag_seconds"),
        F.count_if(lag > sla_seconds).alias("sla_breaches"),
    )


# A sketch of this size puts a percentile within RANK_ERROR of its rank, merged or not.
SKETCH_SIZE = 400
RANK_ERROR = 0.01
PERCENTILES = (0.5, 0.95, 0.99)


def lag_columns(event_ms: str, processing_ms: str, sla_ms: int = 30_000) -> list[Column]:
    """Aggregates of what freshness needs, in a few kilobytes that can be added up later:
    events, greatest lag, breaches of the service level, a KLL sketch of the lags."""
    lag = F.col(processing_ms) - F.col(event_ms)
    return [
        F.count(lag).alias("event_count"),
        F.max(lag).alias("max_lag_ms"),
        F.count_if(lag > sla_ms).alias("sla_breaches"),
        F.kll_sketch_agg_bigint(lag, SKETCH_SIZE).alias("lag_sketch"),
    ]


def lag_sketches(df: DataFrame, event_ms: str, processing_ms: str, by: list[str]) -> DataFrame:
    """:func:`lag_columns` per group."""
    return df.groupBy(*by).agg(*lag_columns(event_ms, processing_ms))


def freshness_percentiles(
    sketches: DataFrame, by: list[str], percentiles: tuple[float, ...] = PERCENTILES
) -> DataFrame:
    """Lag percentiles per group from sketches of its parts, such as hours or micro-batches;
    no event is read again."""
    merged = sketches.filter(F.col("event_count") > 0).groupBy(*by).agg(
        F.sum("event_count").alias("event_count"),
        F.max("max_lag_ms").alias("max_lag_ms"),
        F.sum("sla_breaches").alias("sla_breaches"),
        F.kll_merge_agg_bigint("lag_sketch", SKETCH_SIZE).alias("_merged"),
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(p).alias("percentile"),
                F.kll_sketch_get_quantile_bigint("_merged", F.lit(p)).alias("lag_ms"),
            )
            for p in percentiles
        ]
    )
    return merged.select(*by, "event_count", "max_lag_ms", "sla_breaches", F.inline(listed))
