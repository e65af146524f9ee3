"""A join that splits hot keys by hand, for plans where adaptive execution cannot."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ROWS_PER_SALT = 1_000_000


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> dict:
    """Key values holding at least ``share`` of all rows, with their rows; there are at most
    ``1/share``, so they are few whatever the table's size."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    hot = counts.filter(F.col("n") >= max(1.0, share * total)).collect()
    return {row[key]: row["n"] for row in hot}


def salted_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_salt: int = ROWS_PER_SALT,
    share: float = 0.01,
) -> DataFrame:
    """Equi-join equal to ``large.join(small, key, how)`` with every hot key of ``large``
    spread over partitions of about ``rows_per_salt`` rows, the hotter the more.

    Only rows of hot keys in ``small`` are repeated, once per partition of their key. The
    salt is a hash of the row's own columns, not a random number, so a recomputed task
    sends each row where it went before.
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salting keeps rows of the left side only: inner or left")
    hot = hot_keys(large, key, share)
    if not hot:
        return large.join(small, key, how)

    def salts(column: Column) -> Column:
        count = F.lit(1)
        for value, rows in hot.items():
            count = F.when(column == F.lit(value), ceil(rows / rows_per_salt)).otherwise(count)
        return count.cast("int")

    row = F.xxhash64(*[F.col(f"`{n}`") for n in large.columns])
    left = large.withColumn("_salt", F.pmod(row, salts(F.col(key))).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts(F.col(key)) - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")
