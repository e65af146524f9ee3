"""Exact duplicate removal by grace hashing.

Records are dealt to buckets by a hash of their digest. Each bucket is one task with an
open-addressing table of bounded size that compares complete contents. A content that
finds the table full is spilled to a file in the shared folder with all its later copies
(nothing is ever evicted, so a content is either wholly in the table or wholly spilled),
and the spilled records are dealt again by another hash, until no bucket spills.

Copies take no room in a table, and each task collapses the copies it reads before the
shuffle, so a group with a third of all rows reaches its bucket as one record per task.
Documents find their group again by digest alone, without moving text; should two
contents ever share a digest, those documents are grouped by the text itself.

Cases: a null text counts as empty; equal means identical, unchanged. Of equal texts the
row with the largest ``doc_id`` stays (null is smaller than any; null only if all are
null). Rows repeated with the same ``doc_id`` and text are counted and returned each, and
one of them is kept. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.tables import partitions, staying, text_or_empty, texts, written

TABLE_BYTES = 48 << 20
COLLAPSE_BYTES = 24 << 20

RECORDS = "digest string, text string, keep_id long, n long, spilled boolean"
_RECORDS = pa.schema(
    [
        ("digest", pa.string()),
        ("text", pa.string()),
        ("keep_id", pa.int64()),
        ("n", pa.int64()),
        ("spilled", pa.bool_()),
    ]
)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


class ContentTable:
    """An open-addressing table from content to (largest id, rows), of bounded bytes."""

    def __init__(self, max_bytes: int):
        self.max_bytes, self.bytes = max_bytes, 0
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.entries: list[list] = []  # digest, text, id, n

    def _slot(self, code: int, text: str | None) -> int:
        """The slot of ``text``, or the free one where it belongs."""
        mask = len(self.slots) - 1
        at = (code ^ (code >> 17)) & mask
        while (entry := self.slots[at]) >= 0:
            if text is not None and self.hashes[entry] == code and self.entries[entry][1] == text:
                break
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        for entry, code in enumerate(self.hashes):
            self.slots[self._slot(code, None)] = entry

    def add(self, digest: str, text: str, doc_id: int | None, n: int) -> bool:
        """False if ``text`` is new and the table is full."""
        code = hash(text)
        at = self._slot(code, text)
        if (entry := self.slots[at]) >= 0:
            known = self.entries[entry]
            if doc_id is not None and (known[2] is None or doc_id > known[2]):
                known[2] = doc_id
            known[3] += n
            return True
        if self.entries and self.bytes + 2 * len(text) > self.max_bytes:
            return False
        self.bytes += 2 * len(text) + 200
        self.slots[at] = len(self.entries)
        self.hashes.append(code)
        self.entries.append([digest, text, doc_id, n])
        if 3 * len(self.entries) > 2 * len(self.slots):
            self._grow()
        return True


def _records(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "keep_id", "n")))


def _batch(rows: list, spilled: bool, with_text: bool) -> pa.RecordBatch:
    digest, text, keep, n = zip(*rows)
    values = [digest, text if with_text else [None] * len(rows), keep, n, [spilled] * len(rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip(values, _RECORDS)], schema=_RECORDS
    )


def _batches(rows: list, spilled: bool, with_text: bool) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 2000):
        yield _batch(rows[at : at + 2000], spilled, with_text)


def collapse(records: DataFrame, max_bytes: int = COLLAPSE_BYTES) -> DataFrame:
    """The copies within a task as one record; a full table is passed on and begun anew."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(max_bytes)
        for batch in batches:
            for record in _records(batch):
                if not table.add(*record):
                    yield from _batches(table.entries, True, True)
                    table = ContentTable(max_bytes)
                    table.add(*record)
        yield from _batches(table.entries, True, True)

    return records.mapInArrow(arrays.released(rows), RECORDS)


def resolve(records: DataFrame, level: int, max_bytes: int) -> DataFrame:
    """One row per content of each bucket, without text; what did not fit, with text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(max_bytes)
        for batch in batches:
            if spilled := [record for record in _records(batch) if not table.add(*record)]:
                yield from _batches(spilled, True, True)
        yield from _batches(table.entries, False, False)

    spark = records.sparkSession
    bucket = F.xxhash64("digest", F.lit(level))
    return records.repartition(max(8, partitions(spark)), bucket).mapInArrow(arrays.released(rows), RECORDS)


def contents(
    documents: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    max_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """One row per distinct content: ``digest, keep_id, n``."""
    records = texts(documents).select(
        digest(F.col("text")).alias("digest"),
        "text",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("n"),
    )
    found, pending, level = [], collapse(records), 0
    while pending is not None:
        out = written(resolve(pending, level, max_bytes), f"grace-{level}")
        found.append(out.filter(~F.col("spilled")).select("digest", "keep_id", "n"))
        spilled = out.filter("spilled")
        pending = spilled if spilled.limit(1).count() else None
        level += 1
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result


def dedup(
    documents: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    max_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Per row of ``documents``: ``doc_id, digest, keep_id, group_size, kept, repeats``; the
    last is the number of rows with the same id and text."""
    groups = contents(documents, digest, max_bytes)
    shared = groups.groupBy("digest").agg(F.count("*").alias("contents")).filter("contents > 1")
    # Repeated rows are one link with a count, so that exactly one of them can be kept.
    docs = texts(documents).withColumn("digest", digest(F.col("text")))
    links = docs.select("doc_id", "digest").groupBy("doc_id", "digest").agg(F.count("*").alias("m"))
    if not shared.limit(1).count():
        return _verdicts(links.join(groups, "digest"))
    shared = written(shared.select("digest"), "shared-digests")
    mixed = docs.join(shared, "digest", "left_semi")
    by_text = mixed.groupBy("digest", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("n")
    )
    exact = (
        mixed.groupBy("doc_id", "digest", "text")
        .agg(F.count("*").alias("m"))
        .join(by_text, ["digest", "text"])
        .drop("text")
    )
    plain = links.join(groups, "digest").join(shared, "digest", "left_anti")
    return _verdicts(plain.unionByName(exact))


def _verdicts(joined: DataFrame) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return joined.select("*", copy).select(
        "doc_id",
        "digest",
        "keep_id",
        F.col("n").alias("group_size"),
        stays.alias("kept"),
        F.col("m").alias("repeats"),
    )


def keep(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, one per text, with all their columns."""
    return staying(documents, dedup(documents), sha256(text_or_empty()), "digest")
