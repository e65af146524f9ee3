"""Scores, tier audits and the gate over judged data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import percent, percent2
from tidemark.operators.rules import INVALID, VALID, validate

# Service levels of the quality audit, in percent.
MIN_SCORE = 95.0
MAX_ERROR_SHARE = 5.0


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def verdict_counts(judged: DataFrame, table: str) -> DataFrame:
    """``(source_table, valid_count, invalid_count)`` of one judged frame."""
    status = F.col("validation_status")
    return judged.agg(
        F.count_if(status == VALID).alias("valid_count"),
        F.count_if(status == INVALID).alias("invalid_count"),
    ).select(F.lit(table).alias("source_table"), "valid_count", "invalid_count")


def quality_score(judged: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: share of valid rows in percent, and whether it keeps the service
    levels."""
    return _scored(_union([verdict_counts(df, table) for table, df in judged.items()]))


def score_counts(spark: SparkSession, counts: Mapping[str, tuple[int, int]]) -> DataFrame:
    """:func:`quality_score` from verdicts counted while the tables were written: valid
    and invalid rows per table."""
    rows = [(table, valid, invalid) for table, (valid, invalid) in counts.items()]
    schema = "source_table string, valid_count long, invalid_count long"
    return _scored(spark.createDataFrame(rows, schema))


def _scored(counts: DataFrame) -> DataFrame:
    total = "(valid_count + invalid_count)"
    return counts.select(
        "source_table",
        F.expr(total).alias("total_count"),
        "valid_count",
        "invalid_count",
        percent2("valid_count", total).alias("dq_score"),
        (percent("valid_count", total) < MIN_SCORE).alias("below_sla"),
        (percent("invalid_count", total) > MAX_ERROR_SHARE).alias("error_alert"),
    )


def tier_audit(tiers: Mapping[str, DataFrame | None], time_column: Mapping[str, str]) -> DataFrame:
    """Per tier: presence, rows and the latest processing time (as text).

    ``tiers`` maps a tier to its frame, or to None when nothing has been written yet.
    """
    present = {name: df for name, df in tiers.items() if df is not None}
    reports = []
    for name, df in present.items():
        column = time_column.get(name)
        latest = F.max(F.col(column).cast("string")) if column else F.lit(None).cast("string")
        reports.append(
            df.agg(F.count("*").alias("row_count"), latest.alias("latest_processing")).select(
                F.lit(name).alias("tier"),
                (F.col("row_count") > 0).alias("is_active"),
                "row_count",
                "latest_processing",
            )
        )
    missing = [name for name in tiers if name not in present]
    if missing:
        spark = next(iter(present.values())).sparkSession if present else None
        if spark is None:
            raise ValueError("no tier has any data")
        rows = [(name, False, 0, None) for name in missing]
        reports.append(
            spark.createDataFrame(
                rows, "tier string, is_active boolean, row_count long, latest_processing string"
            )
        )
    return _union(reports)


class QualityGateError(ValueError):
    """Raised when data that must be clean is not."""


def quality_gate(df: DataFrame, table: str, profile: str = "record") -> int:
    """Fail unless every row passes the rules; returns the number of rows checked."""
    judged = validate(df, table, profile)
    row = verdict_counts(judged, table).first()
    if row.invalid_count:
        rejected = judged.filter(F.col("validation_status") == INVALID)
        raise QualityGateError(f"{table}: {row.invalid_count} invalid rows, {_reasons(rejected)}")
    return row.valid_count


def _reasons(rejected: DataFrame, shown: int = 3) -> str:
    """The most frequent reasons, and how many more there are."""
    counts = rejected.groupBy("validation_reason").count()
    top = counts.orderBy(F.desc("count"), "validation_reason").take(shown)
    text = "most often " + "; ".join(f"{r['validation_reason']} ({r['count']})" for r in top)
    more = counts.count() - len(top)
    return text + (f"; and {more} more reasons" if more else "")


def share_gate(scores: DataFrame, errors: DataFrame) -> None:
    """Fail if a table keeps less than its service level of valid rows. ``scores`` is made
    from everything that came in, ``errors`` holds what was rejected."""
    bad = scores.filter("below_sla OR error_alert").orderBy("source_table").collect()
    if bad:
        raise QualityGateError(
            "; ".join(
                f"{row.source_table}: {row.invalid_count} of {row.total_count} rows invalid, "
                + _reasons(errors.filter(F.col("source_table") == row.source_table))
                for row in bad
            )
        )
