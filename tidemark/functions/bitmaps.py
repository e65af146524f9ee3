"""Bloom filters as tables of bitmaps, made and asked by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged

BITMAP_BITS = 32768  # what one bitmap of bitmap_construct_agg holds
BITS_PER_KEY = 12
SEEDS = (1, 2)
MAX_BROADCAST_BITMAPS = 16384  # of 4 KB, 64 MB


def bitmaps_for(keys: Column) -> Column:
    """How many bitmaps hold so many keys."""
    return F.ceil(keys * BITS_PER_KEY / BITMAP_BITS)


def positions(key: Column, bitmaps: Column) -> list[Column]:
    """The bits of a key in a filter of so many bitmaps."""
    bits = bitmaps * BITMAP_BITS
    return [F.pmod(F.xxhash64(F.lit(seed), key), bits) for seed in SEEDS]


def is_set(bitmap: str, bit: str) -> Column:
    """Whether a bitmap has a bit, given the bit's place in the whole filter."""
    place = f"cast(({bit}) % {BITMAP_BITS} AS int)"
    byte = f"cast(conv(hex(substring({bitmap}, {place} div 8 + 1, 1)), 16, 10) AS int)"
    return F.expr(f"(shiftright({byte}, {place} % 8) & 1) = 1")


def filled(bits: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the column ``bit``, by the columns ``by`` and ``bitmap_number``."""
    number = F.expr(f"bit div {BITMAP_BITS}").alias("bitmap_number")
    place = F.expr(f"bit % {BITMAP_BITS}")
    return bits.groupBy(*by, number).agg(F.bitmap_construct_agg(place).alias("bitmap"))


class KeyFilter:
    """A Bloom filter of a column's values. Rows that it lets pass may have one of them; the
    others have none, and need not be moved to be compared."""

    def __init__(self, keys: DataFrame, column: str):
        values = keys.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
        self.bitmaps = values.select(bitmaps_for(F.count("*")).alias("n")).first()["n"]
        if self.usable:
            bit = F.explode(F.array(*positions(F.col("value"), F.lit(self.bitmaps))))
            self.table = staged(filled(values.select(bit.alias("bit"))), "bitmaps")

    @property
    def usable(self) -> bool:
        """A larger filter could not be sent to every task: all rows pass."""
        return self.bitmaps <= MAX_BROADCAST_BITMAPS

    def passing(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows that may have one of the values, with their columns."""
        if not self.usable:
            return rows
        if self.bitmaps == 0:
            return rows.limit(0)
        found = rows
        for place, bit in enumerate(positions(F.col(column), F.lit(self.bitmaps))):
            number, bitmap = f"_number{place}", f"_bitmap{place}"
            known = self.table.select(
                F.col("bitmap_number").alias(number), F.col("bitmap").alias(bitmap)
            )
            found = (
                found.withColumn("_bit", bit)
                .withColumn(number, F.expr(f"_bit div {BITMAP_BITS}"))
                .join(F.broadcast(known), number)
                .filter(is_set(bitmap, "_bit"))
                .drop("_bit", number, bitmap)
            )
        return found.select(*rows.columns)
