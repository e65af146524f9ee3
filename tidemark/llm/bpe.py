"""Byte-level BPE encoding and decoding over the distinct words of the corpus.

A text is split into pre-tokens by the tokenizer's pattern, inside the JVM. Positions are
kept as lists of word numbers per block (``words.py``); the distinct words of all blocks
meet in hash shards, where each word is encoded once; the ids go back to the blocks and
the documents are reassembled by position. Decoding joins every id with the token-byte
table, which is as large as the tokenizer's vocabulary whatever the corpus.

Cases: null and empty texts give no ids; a null or repeated ``doc_id`` is kept as it is,
one row out per row in; other columns are not read; an empty table gives no rows; texts
of any length are encoded whole; the order of rows is not defined.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, words
from tidemark.llm.tables import partitions, texts

ENCODED = "doc_id long, n_tokens long, ids binary"
SLICE_TOKENS = 1 << 17
# A vocabulary file is sent to every executor, so its size is bounded here.
MAX_VOCABULARY_BYTES = 64 << 20

# White space as in the Unicode property of that name; Java's \s is ASCII only.
_SPACE = (
    r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def java_pattern(pattern: str) -> str:
    """The pre-token pattern with its white-space classes spelled out for Java."""
    inside = pattern.replace(r"[^\s", "[^" + _SPACE)
    return inside.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


def read_ranks(path: str) -> bytes:
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; {MAX_VOCABULARY_BYTES} may be sent")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines())}


def pre_tokens(documents: DataFrame, pattern: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(java_pattern(pattern)), F.lit(0))
    return texts(documents).select("doc_id", found.alias("tokens"))


class TokenBytes:
    """The token-byte table: where the bytes of every id stand."""

    def __init__(self, data: bytes):
        by_id = {i: token for token, i in parse_ranks(data).items()}
        table = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.data = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def join(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each stretch of ``ids``, in slices of bounded size."""
        at = np.concatenate([[0], np.cumsum(self.lengths[ids])])[bounds]
        parts = [
            arrays.ragged_take(self.data, self.starts, self.lengths, ids[a : a + SLICE_TOKENS])
            for a in range(0, len(ids), SLICE_TOKENS)
        ]
        whole = np.concatenate([np.empty(0, np.uint8), *parts])
        return [whole[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


_tables: dict[int, TokenBytes] = {}


def token_bytes(data: bytes) -> TokenBytes:
    """One table per worker process."""
    if hash(data) not in _tables:
        _tables[hash(data)] = TokenBytes(data)
    return _tables[hash(data)]


def encode(
    documents: DataFrame, ranks_path: str, pattern: str, decoded: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids``; ids are little-endian unsigned 32-bit integers. With
    ``decoded`` also the bytes that the ids decode to, as :func:`decode` gives them, joined
    where the ids are reassembled."""
    spark = documents.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_ranks(ranks_path))
    tokens = pre_tokens(documents, pattern)

    def encode_shard(rows: pa.Table) -> pa.Table:
        coder = tiktoken.Encoding(
            "ranks",
            pat_str=pattern,
            mergeable_ranks=parse_ranks(vocabulary.value),
            special_tokens={},
        )
        known: dict[bytes, list[int]] = {}
        out = []
        for row in rows.to_pylist():
            ids = []
            for word in words.row_words(row):
                if word not in known:
                    known[word] = coder.encode_ordinary(word.decode())
                ids.append(known[word])
            out.append(
                {
                    "block": row["block"],
                    "places": row["places"],
                    "sizes": arrays.compressed(np.fromiter(map(len, ids), np.int64, len(ids))),
                    "ids": arrays.compressed(np.array([i for x in ids for i in x], np.int64)),
                }
            )
        return pa.Table.from_pylist(out, schema=_SHARD)

    def reassemble(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found = answers.to_pylist()
        schema = _DECODED if decoded else _ENCODED
        out = []
        for row in docs.to_pylist():
            ids, starts, lengths = words.Answers(row["n_words"], found).lists("sizes", "ids")
            codes = arrays.expanded(row["codes"])
            ends = np.cumsum(arrays.expanded(row["sizes"]).astype(np.int64))
            for low, high in slices(ends):
                first = int(ends[low - 1]) if low else 0
                part = codes[first : ends[high - 1]]
                taken = arrays.ragged_take(ids, starts, lengths, part).astype("<u4", copy=False)
                at = np.concatenate([[0], np.cumsum(lengths[part])])
                bounds = at[np.concatenate([[first], ends[low:high]]) - first]
                columns = {
                    "doc_id": row["doc_ids"][low:high],
                    "n_tokens": np.diff(bounds),
                    "ids": [taken[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
                }
                if decoded:
                    columns["decoded"] = token_bytes(vocabulary.value).join(taken, bounds)
                out.append(pa.RecordBatch.from_pydict(columns, schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    shards = max(32, partitions(spark))
    answers = (
        words.word_rows(tokens, shards)
        .groupBy("shard")
        .applyInArrow(
            lambda rows: arrays.freed(encode_shard, rows),
            "block binary, places binary, sizes binary, ids binary",
        )
    )
    return (
        words.doc_rows(tokens)
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            lambda docs, answers: arrays.freed(reassemble, docs, answers),
            ENCODED + ", decoded binary" * decoded,
        )
    )


_SHARD = pa.schema([(n, pa.binary()) for n in ("block", "places", "sizes", "ids")])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_TOKENS tokens, one row at least."""
    low = 0
    while low < len(ends):
        first = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, first + SLICE_TOKENS, side="right")))
        yield low, high
        low = high


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``. An id outside the vocabulary
    is an error."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = encoded.select("doc_id", "n_tokens", "ids").schema.add("decoded", "binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(vocabulary.value)
        for batch in batches:
            decoded = []
            for ids in batch.column("ids"):
                numbers = np.frombuffer(ids.as_buffer() or b"", dtype="<u4")
                decoded += table.join(numbers, np.array([0, len(numbers)]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], schema=_DECODED
            )

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(arrays.released(rows), schema)


_DECODED = pa.schema([*_ENCODED, ("decoded", pa.binary())])
