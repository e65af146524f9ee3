"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item become candidates when they share a window of
``MIN_MATCH`` words (Karp-Rabin hashes). Shared windows on one diagonal make a match; the
longest match of unmarked words is marked as a tile, again and again, until no match of
``MIN_MATCH`` words is left. Tiles do not overlap and may stand in any order, so a
benchmark passage is found when its sentences are reordered, or when other text is put
between them. A document is contaminated when the tiles cover ``COVERAGE`` of the words
of an item.

A benchmark below ``MAX_BENCHMARK_CHARS`` is sent to every task, and documents are judged
where they are read, without a shuffle. Beyond it, windows of documents and of items meet
in a hash join, and the texts of candidate pairs are joined to them.

Cases: null and empty texts contain nothing; items with fewer than ``MIN_MATCH`` words are
too short to be evidence and are never found; an item given twice is reported for each
``item_id``; an empty benchmark finds nothing; rows with equal or null ids are judged each
by their own text; further columns are kept by ``clean`` and not read by ``find``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, shingles
from tidemark.llm.tables import ship, text_or_empty, texts, unused, written

MIN_MATCH = 5
COVERAGE = 0.6
MAX_BENCHMARK_CHARS = 16 << 20

_TILE = "struct<item_start:int,doc_start:int,length:int>"
MATCHES = f"array<struct<item_id:long,coverage:double,tiles:array<{_TILE}>>>"
_MATCHES = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("coverage", pa.float64()),
            (
                "tiles",
                pa.list_(
                    pa.struct([(n, pa.int32()) for n in ("item_start", "doc_start", "length")])
                ),
            ),
        ]
    )
)


def tiles(items: np.ndarray, docs: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple]:
    """Greedy tiles from the places of shared windows: ``items[k]`` in the item matches
    ``docs[k]`` in the document. Longest first; among equals the earliest in the item, then
    in the document."""
    order = np.lexsort((items, docs - items))
    items, docs = items[order], docs[order]
    broken = (np.diff(docs - items) != 0) | (np.diff(items) != 1)
    first = np.concatenate([[0], np.flatnonzero(broken) + 1])
    runs = np.diff(np.append(first, len(items)))
    heap = [
        (-(run + min_match - 1), i, j)
        for run, i, j in zip(runs.tolist(), items[first].tolist(), docs[first].tolist())
    ]
    heapq.heapify(heap)
    item_marks: set[int] = set()
    doc_marks: set[int] = set()
    found = []
    while heap:
        size, i, j = heapq.heappop(heap)
        free = [k for k in range(-size) if i + k not in item_marks and j + k not in doc_marks]
        if len(free) == -size:
            found.append((i, j, -size))
            item_marks.update(range(i, i - size))
            doc_marks.update(range(j, j - size))
            continue
        # Marks of earlier tiles cut the match; its free stretches stay candidates.
        start = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= min_match:
                    heapq.heappush(heap, (start - k, i + free[start], j + free[start]))
                start = k
    return found


class Items:
    """The windows of benchmark items, by hash."""

    def __init__(self, ids: list[int], item_texts: list[str], min_match: int = MIN_MATCH):
        self.min_match = min_match
        words, bounds = shingles.word_hashes(item_texts)
        found, inside = shingles.windows(words, bounds, min_match)
        item = np.repeat(np.arange(len(ids)), np.diff(inside))
        place = np.arange(len(found)) - inside[item] if len(found) else np.empty(0, np.int64)
        order = np.argsort(found, kind="stable")
        self.hashes, self.first = np.unique(found[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(found)))
        self.item, self.place = item[order], place[order]
        self.ids, self.sizes = ids, np.diff(bounds)

    def matches(self, some: list[str | None], coverage: float = 0.0) -> Iterator[list[dict]]:
        """Of each text: the items covered by at least ``coverage``, with their tiles."""
        for _, group in shingles.groups(some):
            words, bounds = shingles.word_hashes(group)
            found, inside = shingles.windows(words, bounds, self.min_match)
            at = np.searchsorted(self.hashes, found)
            at[at == len(self.hashes)] = 0
            hit = np.flatnonzero(self.hashes[at] == found) if len(self.hashes) else []
            limits = np.searchsorted(hit, inside)
            for doc, (a, b) in enumerate(zip(limits[:-1], limits[1:])):
                if a == b:
                    yield []
                else:
                    places = hit[a:b]
                    yield self._tiled(at[places], places - inside[doc], coverage)

    def _tiled(self, keys: np.ndarray, places: np.ndarray, coverage: float) -> list[dict]:
        which = np.arange(len(self.item))
        rows = arrays.ragged_take(which, self.first, self.count, keys)
        docs = np.repeat(places, self.count[keys])
        item, at = self.item[rows], self.place[rows]
        order = np.argsort(item, kind="stable")
        out = []
        for part in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
            k = int(item[part[0]])
            found = tiles(at[part], docs[part], self.min_match)
            covered = sum(t[2] for t in found) / int(self.sizes[k])
            if covered >= coverage:
                names = ("item_start", "doc_start", "length")
                out.append(
                    {
                        "item_id": self.ids[k],
                        "coverage": covered,
                        "tiles": [dict(zip(names, t)) for t in sorted(found)],
                    }
                )
        return out


def _small(benchmark: DataFrame, limit: int) -> bool:
    return (benchmark.agg(F.sum(F.length(text_or_empty()) + 16)).first()[0] or 0) <= limit


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long"), text_or_empty().alias("item_text"))


def matches_column(benchmark: DataFrame, coverage: float) -> Column:
    """The matches of column ``text`` with a benchmark small enough to be sent around."""
    rows = _items(benchmark).orderBy("item_id", "item_text").collect()
    context = benchmark.sparkSession.sparkContext
    sent = context.broadcast(([r.item_id for r in rows], [r.item_text for r in rows]))

    @F.arrow_udf(MATCHES)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(*sent.value)
        for batch in batches:
            yield pa.array(list(items.matches(batch.to_pylist(), coverage)), _MATCHES)
        arrays.release()

    return found("text")


def _matches_by_join(documents: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """``doc_id, tie, matches`` of the documents that share a window with some item, where
    ``tie`` is a hash of the text."""

    def hashed(df: DataFrame, id_column: str) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, ties = batch.column(0), batch.column(1)
                for first, group in shingles.groups(batch.column(2).to_pylist()):
                    words, bounds = shingles.word_hashes(group)
                    found, inside = shingles.windows(words, bounds, MIN_MATCH)
                    row = first + np.repeat(np.arange(len(group)), np.diff(inside))
                    _, one = np.unique(np.stack([row.astype(np.uint64), found]), axis=1, return_index=True)
                    row, found = pa.array(row[one]), found[one].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(row), ties.take(row), pa.array(found)],
                        names=[id_column, "tie", "window"],
                    )

        return df.mapInArrow(arrays.released(rows), f"{id_column} long, tie long, window long")

    docs = texts(documents).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    items = _items(benchmark).select("item_id", F.xxhash64("item_text").alias("tie"), "item_text")
    seeds = hashed(items, "item_id").select("item_id", F.col("tie").alias("item_tie"), "window")
    pairs = hashed(docs, "doc_id").join(seeds, "window").drop("window").distinct()
    pairs = written(pairs, "tiling-pairs")

    def same(left: Column, right: Column) -> Column:
        return left.eqNullSafe(right)

    d, p = docs.dropDuplicates(["doc_id", "tie"]).alias("d"), pairs.alias("p")
    i = items.dropDuplicates(["item_id", "tie"]).alias("i")
    full = p.join(
        d, (F.col("p.tie") == F.col("d.tie")) & same(F.col("p.doc_id"), F.col("d.doc_id"))
    ).join(
        i, (F.col("p.item_tie") == F.col("i.tie")) & same(F.col("p.item_id"), F.col("i.item_id"))
    )

    @F.arrow_udf(MATCHES)
    def tiled(item_ids: pa.Array, item_texts: pa.Array, doc_texts: pa.Array) -> pa.Array:
        out = []
        for item_id, item, doc in zip(
            item_ids.to_pylist(), item_texts.to_pylist(), doc_texts.to_pylist()
        ):
            out += Items([item_id], [item]).matches([doc], coverage)
        return pa.array(out, _MATCHES)

    found = tiled(F.col("p.item_id"), F.col("i.item_text"), F.col("d.text"))
    return (
        full.select(F.col("p.doc_id").alias("doc_id"), F.col("p.tie").alias("tie"), found.alias("m"))
        .groupBy("doc_id", "tie")
        .agg(F.array_sort(F.flatten(F.collect_list("m"))).alias("matches"))
    )


def matched(
    documents: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    max_chars: int = MAX_BENCHMARK_CHARS,
    name: str = "_matches",
) -> DataFrame:
    """``documents`` with a column ``name``: the items a document contains, with their
    tiles."""
    ship(documents.sparkSession)
    if _small(benchmark, max_chars):
        return documents.withColumn(name, matches_column(benchmark, coverage))
    own, mark = unused(documents, "_id"), unused(documents, "_tie")
    found = _matches_by_join(documents, benchmark, coverage).select(
        F.col("doc_id").alias(own), F.col("tie").alias(mark), F.col("matches").alias(name)
    )
    tie = F.xxhash64(text_or_empty())
    same = (tie == F.col(mark)) & F.col("doc_id").cast("long").eqNullSafe(F.col(own))
    none = F.array().cast(MATCHES)
    joined = documents.join(found, same, "left").drop(own, mark)
    return joined.withColumn(name, F.coalesce(name, none))


def find(
    documents: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    max_chars: int = MAX_BENCHMARK_CHARS,
) -> DataFrame:
    """Per row: ``doc_id, contaminated, coverage`` (of the best item, 0 without one),
    ``items`` (ids, ascending) and ``matches`` with their tiles."""
    rows = matched(documents.select("doc_id", "text"), benchmark, coverage, max_chars)
    return rows.select(
        F.col("doc_id").cast("long"),
        (F.size("_matches") > 0).alias("contaminated"),
        F.coalesce(F.array_max("_matches.coverage"), F.lit(0.0)).alias("coverage"),
        F.array_sort(F.array_distinct("_matches.item_id")).alias("items"),
        F.col("_matches").alias("matches"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``documents`` that contain no item, with all their columns."""
    name = unused(documents, "_matches")
    found = matched(documents, benchmark, coverage, name=name)
    return found.filter(F.size(name) == 0).drop(name)
