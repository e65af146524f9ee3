"""Global work on distinct words without moving every token.

A block is a run of documents of one input batch. It numbers its distinct words, the most
frequent first; its documents become lists of those numbers. Only the words travel to
their hash shard, packed into one row per block and shard, so the most frequent word
crosses the shuffle once per block however often it occurs, and no key is hot. The shard
answers per block, and the answers meet the block's lists again.

Word rows and document rows are two passes over the input. A block's key is a digest of
its words and ids: if the passes ever cut the input differently, an answer is missing and
``Answers`` raises instead of giving a wrong result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm import arrays

# A tokeniser turns a batch into the number of tokens per row, and the tokens.
Tokeniser = Callable[[pa.RecordBatch], tuple[np.ndarray, pa.Array]]

BLOCK_TOKENS = 1 << 21

WORDS = "shard int, block binary, places binary, lengths binary, words binary, weights binary"
DOCS = "block binary, doc_ids array<long>, sizes binary, codes binary, n_words int"


@dataclass
class Block:
    key: bytes
    doc_ids: pa.Array
    sizes: np.ndarray
    codes: np.ndarray
    words: pa.Array


def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """Tokeniser of batches that carry their tokens as a list column ``tokens``."""
    lists = batch.column("tokens")
    return np.diff(lists.offsets.to_numpy()), lists.flatten()


def cut(batch: pa.RecordBatch, tokenise: Tokeniser, limit: int = BLOCK_TOKENS) -> Iterator[Block]:
    """Blocks of at most ``limit`` tokens, or of one document."""
    sizes, tokens = tokenise(batch)
    ends = np.cumsum(sizes)
    row = 0
    while row < batch.num_rows:
        before = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = tokens.slice(before, int(ends[stop - 1]) - before).dictionary_encode()
        codes = part.indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(codes, minlength=len(part.dictionary))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order))
        words = part.dictionary.take(pa.array(order)).cast(pa.binary())
        ids = batch.column("doc_id").slice(row, stop - row)
        data, offsets = arrays.byte_runs(words)
        digest = hashlib.blake2b(data.tobytes(), digest_size=16)
        digest.update(offsets.tobytes())
        digest.update(repr(ids.to_pylist()).encode())
        digest.update(sizes[row:stop].tobytes())
        yield Block(digest.digest(), ids, sizes[row:stop], rank[codes], words)
        row = stop


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def word_rows(
    tokens: DataFrame,
    shards: int,
    tokenise: Tokeniser = listed,
    weigh: Callable[[Block], np.ndarray] | None = None,
) -> DataFrame:
    """The distinct words of every block, by shard. ``weigh`` gives each word a count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in cut(batch, tokenise):
                if not len(block.words):
                    continue
                shard = (arrays.hashes(block.words) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                data, offsets = arrays.byte_runs(block.words.take(pa.array(order)))
                weights = weigh(block)[order] if weigh else None
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                found = [
                    {
                        "shard": s,
                        "block": block.key,
                        "places": arrays.compressed(order[a:b]),
                        "lengths": arrays.compressed(np.diff(offsets[a : b + 1])),
                        "words": _zip(data[offsets[a] : offsets[b]].tobytes()),
                        "weights": None if weights is None else arrays.compressed(weights[a:b]),
                    }
                    for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))
                    if b > a
                ]
                yield pa.RecordBatch.from_pylist(found, schema=_WORDS)

    return tokens.mapInArrow(arrays.released(rows), WORDS)


_WORDS = pa.schema(
    [("shard", pa.int32())]
    + [(n, pa.binary()) for n in ("block", "places", "lengths", "words", "weights")]
)


def doc_rows(tokens: DataFrame, tokenise: Tokeniser = listed) -> DataFrame:
    """One row per block: its documents as lists of word numbers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in cut(batch, tokenise):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.key], pa.binary()),
                        pa.array([block.doc_ids.to_pylist()], pa.list_(pa.int64())),
                        pa.array([arrays.compressed(block.sizes)], pa.binary()),
                        pa.array([arrays.compressed(block.codes)], pa.binary()),
                        pa.array([len(block.words)], pa.int32()),
                    ],
                    names=["block", "doc_ids", "sizes", "codes", "n_words"],
                )

    return tokens.mapInArrow(arrays.released(rows), DOCS)


def row_words(row: dict) -> list[bytes]:
    """The words of a row of ``word_rows``."""
    data = _unzip(row["words"])
    ends = np.cumsum(arrays.expanded(row["lengths"]).astype(np.int64)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def row_array(row: dict) -> pa.Array:
    """The same as an Arrow array."""
    offsets = np.concatenate([[0], np.cumsum(arrays.expanded(row["lengths"]).astype(np.int64))])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(_unzip(row["words"]))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


class Answers:
    """What the shards answered for the words of one block, by word number."""

    def __init__(self, n_words: int, rows: list[dict]):
        self.rows = [(arrays.expanded(r["places"]), r) for r in rows]
        seen = np.zeros(n_words, dtype=bool)
        for places, _ in self.rows:
            seen[places] = True
        if not seen.all():
            raise RuntimeError(f"{int((~seen).sum())} words of a block have no answer")
        self.n_words = n_words

    def numbers(self, column: str, width: int = 4) -> np.ndarray:
        out = np.zeros(self.n_words, dtype=np.int64)
        for places, row in self.rows:
            out[places] = arrays.expanded(row[column], width)
        return out

    def lists(self, sizes: str, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, and where the list of each word starts and how long it is."""
        starts, lengths = (np.zeros(self.n_words, dtype=np.int64) for _ in range(2))
        parts, at = [np.empty(0, np.uint32)], 0
        for places, row in self.rows:
            size = arrays.expanded(row[sizes]).astype(np.int64)
            lengths[places] = size
            starts[places] = at + np.cumsum(size) - size
            parts.append(arrays.expanded(row[values]))
            at += len(parts[-1])
        return np.concatenate(parts), starts, lengths
