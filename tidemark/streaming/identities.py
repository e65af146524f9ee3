"""Which events were stored before, however long ago.

Identities are kept in a keyed table: a 64-bit hash of what tells events apart as key, and
a second one, so that two events count as one only if 128 bits agree. Every batch adds its
new identities as files of their own, with key range and Bloom filter, so a batch reads
only files that can hold one of its keys: with no copies around, hardly any. Nothing is kept
in memory or in the state of a query, and an identity is never forgotten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import identified
from tidemark.schemas import Entity
from tidemark.sinks.keyed import KeyedTable

SMALL_FILES = 64  # from so many small files on, they are put together


def identity_table(spark: SparkSession, output_base: str, entity: Entity) -> KeyedTable:
    return KeyedTable(spark, f"{output_base.rstrip('/')}/identities/{entity.name}", "identity")


def _hash(seed: int, columns: list[Column]) -> Column:
    # Nulls leave a hash as it is; whether a value is there counts as well.
    return F.xxhash64(F.lit(seed), *columns, *[column.isNull() for column in columns])


def unseen(table: KeyedTable, events: DataFrame, key: str, mark: dict | None = None) -> DataFrame:
    """The rows of ``events`` (distinct ones) that ``table`` does not know, which it knows from
    then on. With the ``mark`` of the last call the answer is that of the last call, so that a
    batch whose rows were not stored can be repeated."""
    marked, names = identified(events, key, ())
    columns = [F.col(name) for name in names]
    marked = marked.withColumns({"_first": _hash(1, columns), "_second": _hash(2, columns)})
    given = marked.groupBy(F.col("_first").alias("identity")).agg(
        F.array_sort(F.collect_set("_second")).alias("seconds")
    )

    def combine(old: Column, new: Column) -> Column:
        added = F.array_except(new["seconds"], old["seconds"])
        more = old.withField("seconds", F.concat(old["seconds"], added))
        return F.when(old.isNull(), new).when(F.size(added) > 0, more)

    changes = table.merge(given, combine, mark=mark).changes
    none = F.array().cast("array<bigint>")
    fresh = changes.select(
        F.col("new.identity").alias("_first"),
        F.explode(
            F.array_except("new.seconds", F.coalesce(F.col("old.seconds"), none))
        ).alias("_second"),
    )
    found = marked.join(fresh, ["_first", "_second"], "left_semi").select(*events.columns)
    if len(table.files()) > SMALL_FILES:
        table.compact()
    return found
