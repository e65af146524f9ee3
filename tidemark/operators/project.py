"""Keeping costly projections from being repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column evaluated here.

    The optimizer moves a later filter below a projection by copying the projection's
    expressions into it, once per use. For parsed JSON and long rule chains the copies
    cost far more than the rows they save. A filter cannot move below a generator that
    makes its columns, so the columns pass through one that yields each row unchanged.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")
