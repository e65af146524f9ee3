"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

The exact side is a table of postings, (key, doc_id, times held), so the number of
documents holding a line and the largest of them are known after any order of insertions
and deletions. A key is listed when at least ``MIN_DOCS`` documents hold it. The keys
listed in a shard are also in that shard's cuckoo filter, 16-bit fingerprints in buckets
of four, from which they are removed again when deletions take them off the list.

Cleaning sends the filters to the tasks (below ``MAX_FILTER_BYTES``): a document whose
lines all miss is done where it is read; the possible hits of the others are joined with
the exact table, which has the last word. Beyond that size all lines are joined.

A state is a folder per version in the shared folder, written whole before it is used, so
a job that is lost half-way leaves the version before as it was.

Lines are what stands between line feeds (a null or empty text is one empty line). A
line's key is the line without white space at both ends, with A-Z lower-cased; keys with
fewer than ``MIN_CHARS`` code points are never listed. Listed lines are dropped in all
documents but the one with the largest ``doc_id``. Cases: rows without an id count as one
document, smaller than all others; rows repeated with one id are one document held more
than once, and a line goes or stays in all of them; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.tables import partitions, texts, written

MIN_CHARS = 20
MIN_DOCS = 3
MAX_FILTER_BYTES = 64 << 20
_BLANK = b" \t\n\x0b\x0c\r"
SLOTS, MAX_KICKS = 4, 200


def line_keys(text: str | None) -> list[bytes | None]:
    """The key of every line, sixteen bytes; None where a line is too short."""
    out = []
    for line in (text or "").encode().lower().split(b"\n"):
        line = line.strip(_BLANK)
        long = len(line) >= MIN_CHARS and (line.isascii() or len(line.decode()) >= MIN_CHARS)
        out.append(hashlib.blake2b(line, digest_size=16).digest() if long else None)
    return out


class CuckooFilter:
    """Tables of fingerprints; a full table is followed by a further one twice its size."""

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    @staticmethod
    def _places(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each hash, in a table of ``n`` buckets."""
        mark = np.maximum(hashes & np.uint64(0xFFFF), np.uint64(1))
        first = (hashes >> np.uint64(16)) & np.uint64(n - 1)
        second = first ^ (arrays.mix(mark) & np.uint64(n - 1))
        return mark.astype(np.uint16), first.astype(np.int64), second.astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), dtype=bool)
        for table in self.tables:
            mark, first, second = self._places(hashes, len(table))
            found |= (table[first] == mark[:, None]).any(axis=1)
            found |= (table[second] == mark[:, None]).any(axis=1)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        if not self.tables:
            buckets = 1 << max(3, int(np.ceil(np.log2(len(hashes) / (SLOTS * 0.8)))))
            self.tables.append(np.zeros((buckets, SLOTS), dtype=np.uint16))
        mark, first, second = self._places(hashes, len(self.tables[-1]))
        for k, (m, a, b) in enumerate(zip(mark.tolist(), first.tolist(), second.tolist())):
            if not self._put(self.tables[-1], m, a, b):
                larger = max(2 * len(self.tables[-1]), 8)
                self.tables.append(np.zeros((larger, SLOTS), dtype=np.uint16))
                return self.insert(hashes[k:])

    @staticmethod
    def _put(table: np.ndarray, mark: int, first: int, second: int) -> bool:
        """Moves entries to their other bucket until one finds room; without room all
        moves are taken back, so no entry is lost."""
        for bucket in (first, second):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return True
        moves, bucket = [], first
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            moves.append((bucket, slot, int(table[bucket, slot])))
            mark, table[bucket, slot] = moves[-1][2], mark
            step = arrays.mix(np.array([mark], dtype=np.uint64))[0]
            bucket = int(np.uint64(bucket) ^ (step & np.uint64(len(table) - 1)))
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return True
        for bucket, slot, old in reversed(moves):
            table[bucket, slot] = old
        return False

    def delete(self, hashes: np.ndarray) -> None:
        for k in range(len(hashes)):
            for table in reversed(self.tables):
                mark, first, second = (int(x[0]) for x in self._places(hashes[k : k + 1], len(table)))
                for bucket in (first, second):
                    held = np.flatnonzero(table[bucket] == mark)
                    if len(held):
                        table[bucket, held[0]] = 0
                        break
                else:
                    continue
                break

    def to_rows(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]

    @classmethod
    def from_rows(cls, rows: list[bytes]) -> CuckooFilter:
        return cls([np.frombuffer(r, dtype=np.uint16).reshape(-1, SLOTS).copy() for r in rows])


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8")[1::2].astype(np.uint64)


def _shard(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def postings(documents: DataFrame) -> DataFrame:
    """``key, doc_id`` once per row of ``documents`` and key."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {k for k in line_keys(text) if k is not None}
                keys += found
                ids += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"]
            )

    return texts(documents).mapInArrow(arrays.released(rows), "key binary, doc_id long")


class LineIndex:
    """The state: postings and filters of one version. Every change gives a new one."""

    def __init__(self, spark: SparkSession, shards: int | None = None):
        self.spark = spark
        self.shards = shards or max(8, partitions(spark))
        self.postings = spark.createDataFrame([], "key binary, doc_id long, times long")
        self.listed = spark.createDataFrame([], "shard int, key binary, holder long")
        self.filters = spark.createDataFrame([], "shard int, tables array<binary>")

    def insert(self, documents: DataFrame) -> LineIndex:
        return self._changed(documents, 1)

    def delete(self, documents: DataFrame) -> LineIndex:
        """The state without ``documents``, as if they had not been inserted. What was
        never inserted is ignored."""
        return self._changed(documents, -1)

    def _changed(self, documents: DataFrame, times: int) -> LineIndex:
        new = LineIndex.__new__(LineIndex)
        new.spark, new.shards = self.spark, self.shards
        delta = postings(documents).withColumn("times", F.lit(times).cast("long"))
        held = self.postings.unionByName(delta).groupBy("key", "doc_id")
        new.postings = written(
            held.agg(F.sum("times").alias("times")).filter("times > 0"), "line-postings"
        )
        totals = new.postings.groupBy("key").agg(
            F.count("*").alias("docs"), F.max("doc_id").alias("holder")
        )
        listed = totals.filter(F.col("docs") >= MIN_DOCS)
        listed = listed.select(_shard("key", self.shards).alias("shard"), "key", "holder")
        new.listed = written(listed, "listed-lines")
        new.filters = written(self._filters(new.listed), "line-filters")
        return new

    def _filters(self, listed: DataFrame) -> DataFrame:
        """The filters after the keys that came onto or left the list."""
        old = self.listed.select("shard", "key", F.lit(-1).alias("change"))
        changes = (
            listed.select("shard", "key", F.lit(1).alias("change"))
            .unionByName(old)
            .groupBy("shard", "key")
            .agg(F.sum("change").cast("int").alias("change"))
            .filter("change != 0")
        )

        def update(filters: pa.Table, changed: pa.Table) -> pa.Table:
            rows = filters.to_pylist()
            cuckoo = CuckooFilter.from_rows(rows[0]["tables"] if rows else [])
            shard = (filters if rows else changed).column("shard")[0].as_py()
            keys = changed.column("key").to_pylist()
            sign = np.array(changed.column("change").to_pylist(), dtype=np.int64)
            marks = _hashes(keys)
            cuckoo.delete(marks[sign < 0])
            cuckoo.insert(marks[sign > 0])
            return pa.table(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "tables": pa.array([cuckoo.to_rows()], pa.list_(pa.binary())),
                }
            )

        return (
            self.filters.groupBy("shard")
            .cogroup(changes.groupBy("shard"))
            .applyInArrow(update, "shard int, tables array<binary>")
        )

    def _screen(self, max_bytes: int) -> Column:
        """``n_lines`` of column ``text``, and the keys that may be listed."""
        size = F.expr("aggregate(tables, 0L, (n, t) -> n + octet_length(t))")
        total = self.filters.agg(F.sum(size)).first()[0] or 0
        held = None
        if total <= max_bytes:
            rows = self.filters.select(F.explode("tables").alias("t")).collect()
            held = self.spark.sparkContext.broadcast([bytes(r.t) for r in rows])

        @F.arrow_udf("struct<n_lines:long,maybe:array<binary>>")
        def screen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            cuckoo = CuckooFilter.from_rows(held.value) if held else None
            for batch in batches:
                lines = [line_keys(text) for text in batch.to_pylist()]
                found = [[k for k in dict.fromkeys(keys) if k is not None] for keys in lines]
                if cuckoo:
                    flat = [k for keys in found for k in keys]
                    hits = iter(cuckoo.contains(_hashes(flat)).tolist())
                    found = [[k for k in keys if next(hits)] for keys in found]
                yield pa.StructArray.from_arrays(
                    [
                        pa.array([len(keys) for keys in lines], pa.int64()),
                        pa.array(found, pa.list_(pa.binary())),
                    ],
                    names=["n_lines", "maybe"],
                )

        return screen("text")

    def clean(self, documents: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
        """Per row: ``doc_id, n_lines, n_dropped, text`` with the lines that stay."""
        docs = texts(documents).withColumn("_s", self._screen(max_bytes))
        docs = docs.select("doc_id", "text", "_s.n_lines", "_s.maybe")
        same_text = F.xxhash64("text").alias("tie")
        hits = docs.filter(F.size("maybe") > 0)
        asked = hits.select("doc_id", same_text, F.explode("maybe").alias("key")).distinct()
        goes = F.col("doc_id").isNull() | (F.col("doc_id") != F.col("holder"))
        drops = (
            asked.join(self.listed, "key")
            .filter(goes & F.col("holder").isNotNull())
            .groupBy("doc_id", "tie")
            .agg(F.collect_set("key").alias("drops"))
            .select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "drops")
        )

        @F.arrow_udf("struct<n_dropped:long,text:string>")
        def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for some, gone in batches:
                out = []
                for text, keys in zip(some.to_pylist(), gone.to_pylist()):
                    keys = set(keys or ())
                    kept = [
                        line
                        for line, key in zip(text.split("\n"), line_keys(text))
                        if key not in keys
                    ]
                    dropped = text.count("\n") + 1 - len(kept)
                    out.append({"n_dropped": dropped, "text": "\n".join(kept)})
                yield pa.array(out, pa.struct([("n_dropped", pa.int64()), ("text", pa.string())]))

        same = (F.xxhash64("text") == F.col("_tie")) & F.col("doc_id").eqNullSafe(F.col("_id"))
        cleaned = (
            hits.join(drops, same, "left")
            .withColumn("_c", without("text", "drops"))
            .select("doc_id", "n_lines", "_c.n_dropped", "_c.text")
        )
        whole = docs.filter(F.size("maybe") == 0).select(
            "doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), "text"
        )
        return cleaned.unionByName(whole)
