"""Token ids on disk in Simple-8b words, and back.

``pack`` turns integers into 64-bit words: four bits select how many values of which width
share the other sixty, from sixty single bits to one value of sixty bits. A value that is
too wide is an escape: its word holds a place in a list of raw values. Values are coded in
blocks of ``BLOCK``; the header holds each block's first word and first escape, so any
block decodes on its own, all words of one selector at once.

Files: documents are range-partitioned and sorted by ``doc_id``; each task encodes its run
and writes segments, rows of a Parquet file that hold whole documents: the file's number,
the segment's first place in the file, the ids of its documents, their sizes and their
token ids, both packed. Readers add the sizes of the files before, so a place in the whole
sequence needs no pass over the data. The Parquet container gives atomic commits and any
Hadoop store; lost executors repeat their task only.

Texts are cut into units that the tokenizer encodes on their own, and every worker
remembers the ids of those it met lately, so a frequent unit is encoded once per worker; the
documents' ids are gathered from those of the distinct units of some megabytes of text.

Cases: a null or empty text has the end id alone; null ids come first; rows with equal ids
are all kept, ordered by a hash of the text; other columns are not read; an empty table
gives no rows; a text of any length is one run of ids in one segment.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import arrays, shingles
from tidemark.llm.tables import ship, texts

BLOCK = 1 << 16
SEGMENT_IDS = 1 << 18
MAX_TOKENIZER_BYTES = 64 << 20
MEMO_UNITS = 300_000
GROUP_CHARS = 4 << 20

# Selectors 1 to 14: values per word and bits per value; 0 is an escape.
SELECTORS = [(60 // bits, bits) for bits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)]
_COUNTS = np.array([1, *(count for count, _ in SELECTORS)], dtype=np.int64)
_HEADER = struct.Struct("<4sIQ")
MAGIC = b"S8B1"


_LIMITS = np.array([(1 << bits) - 1 for _, bits in SELECTORS], dtype=np.uint64)
_SMALL_WIDTHS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64)).astype(np.uint8)


def _choices(values: np.ndarray) -> np.ndarray:
    """For every place the selector that would take most values from there on. Beyond the
    end there is room for padding."""
    n = len(values)
    if n and int(values.max()) < 1 << 16:
        width = _SMALL_WIDTHS[values.astype(np.int64)]
    else:
        width = np.searchsorted(_LIMITS, values).astype(np.uint8)
    width = np.concatenate([width, np.zeros(64, dtype=np.uint8)])
    widest, held = width[:n].copy(), 1
    choice = np.zeros(n, dtype=np.uint8)
    for k in range(len(SELECTORS) - 1, -1, -1):
        count = SELECTORS[k][0]
        for place in range(held, count):
            np.maximum(widest, width[place : place + n], out=widest)
        held = count
        fits = widest <= k
        if not fits.any():
            break
        choice[fits] = k + 1
    return choice


def _pack_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of one block of unsigned 64-bit values."""
    n = len(values)
    choice = _choices(values)
    following = (np.arange(n) + _COUNTS[choice]).tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at = following[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(64, dtype=np.uint64)])
    escaped = chosen == 0
    words[escaped] |= np.arange(int(escaped.sum()), dtype=np.uint64)
    for k in np.unique(chosen[~escaped]).tolist():
        count, bits = SELECTORS[k - 1]
        mine = np.flatnonzero(chosen == k)
        held = np.zeros(len(mine), dtype=np.uint64)
        for place in range(count):
            held |= padded[starts[mine] + place] << np.uint64(place * bits)
        words[mine] |= held
    return words, values[starts[escaped]]


def pack(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, dtype=np.uint64)
    parts = [_pack_block(values[a : a + BLOCK]) for a in range(0, len(values), BLOCK)]
    bounds = np.zeros((2, len(parts) + 1), dtype="<u8")
    for row, which in enumerate((0, 1)):
        bounds[row, 1:] = np.cumsum([len(p[which]) for p in parts])
    body = [p[0].astype("<u8").tobytes() for p in parts]
    body += [p[1].astype("<u8").tobytes() for p in parts]
    return _HEADER.pack(MAGIC, len(parts), len(values)) + bounds.tobytes() + b"".join(body)


def _unpack_block(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[chosen]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.zeros(max(n, int(ends[-1]) if len(ends) else 0), dtype=np.uint64)
    for k in np.unique(chosen):
        mine = chosen == k
        if k == 0:
            places = words[mine] & np.uint64((1 << 60) - 1)
            out[starts[mine]] = escapes[places.astype(np.int64)]
            continue
        count, bits = SELECTORS[k - 1]
        shifts = (np.arange(count) * bits).astype(np.uint64)
        held = (words[mine][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        out[starts[mine][:, None] + np.arange(count)] = held
    return out[:n]


def unpack(data: bytes) -> np.ndarray:
    magic, blocks, n = _HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a packed sequence")
    bounds = np.frombuffer(data, "<u8", 2 * (blocks + 1), _HEADER.size).reshape(2, -1)
    words = np.frombuffer(data, "<u8", offset=_HEADER.size + bounds.nbytes)
    first = int(bounds[0, -1])
    at = bounds.astype(np.int64)
    parts = [
        _unpack_block(
            words[at[0, b] : at[0, b + 1]],
            words[first + at[1, b] : first + at[1, b + 1]],
            min(BLOCK, n - b * BLOCK),
        )
        for b in range(blocks)
    ]
    return np.concatenate([np.empty(0, np.uint64), *parts])


_GAP, _LETTER, _SIGN, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x0A]] = _GAP
for _low, _high in ("AZ", "az"):
    _CLASS[ord(_low) : ord(_high) + 1] = _LETTER
# ASCII signs but the apostrophe, which may begin a contraction.
for _low, _high in ("!&", "(/", ":@", "[`", "{~"):
    _CLASS[ord(_low) : ord(_high) + 1] = _SIGN


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, with line feeds at both ends, cut into what the tokenizer surely encodes
    on its own: bytes, and the bounds of the units.

    Words stand between blanks and line feeds. A word of Latin letters and signs is cut
    into its runs of letters, lower-cased as the tokenizer would, and of signs. A word with
    anything else in it (digits, apostrophes, other scripts, the start of a special token)
    is one unit as it stands.
    """
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # of U+00C0 to U+00FF
    second = data[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7)]  # the two that are no letters
    kind[lead] = kind[lead + 1] = _LETTER
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    kind[special] = _OTHER
    lowered = data.copy()
    lowered[(data >= ord("A")) & (data <= ord("Z"))] += 32
    lowered[lead[data[lead + 1] < 0x9F] + 1] += 32

    inside = kind != _GAP
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    others = np.concatenate([[0], np.cumsum(kind == _OTHER)])
    mixed = np.flatnonzero(others[ends] > others[starts])
    if len(mixed):
        whole = np.zeros(len(data) + 1, dtype=np.int8)
        whole[starts[mixed]], whole[ends[mixed]] = 1, -1
        whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
        kind[whole] = _OTHER
        lowered[whole] = data[whole]
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    firsts = edges[kind[edges] != _GAP]
    lasts = edges[kind[edges - 1] != _GAP]
    return lowered, firsts, lasts


class WordIds:
    """Token ids of texts by a memo of units. A unit of letters is one piece of the
    tokenizer, whose last id is marked as a word end: those are encoded many at a time,
    all others one by one. The memo has two generations: when the young one is full, what
    was not used since the last change is forgotten."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        size = self.tokenizer.get_vocab_size()
        self.is_end = [str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, found: list[bytes]) -> None:
        texts_of = [unit.decode() for unit in found]
        pieces = [(u, t) for u, t in zip(found, texts_of) if t.isalpha()]
        for unit, text in zip(found, texts_of):
            if not text.isalpha():
                self.young[unit] = self._whole(text)
        for at in range(0, len(pieces), 500):
            part = pieces[at : at + 500]
            joined = " ".join(text for _, text in part)
            ids = self.tokenizer.encode(joined, add_special_tokens=False).ids
            ends = [i + 1 for i, token in enumerate(ids) if self.is_end[token]]
            if len(ends) == len(part) and ends[-1] == len(ids):
                data = np.array(ids, dtype="<u4").tobytes()
                for (unit, _), a, b in zip(part, [0, *ends], ends):
                    self.young[unit] = data[4 * a : 4 * b]
            else:  # some unit is more than one piece
                for unit, text in part:
                    self.young[unit] = self._whole(text)

    def _known(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.young) > MEMO_UNITS:
            self.old, self.young = self.young, {}
        missing = [unit for unit in distinct if unit not in self.young]
        for unit in missing:
            if (ids := self.old.get(unit)) is not None:
                self.young[unit] = ids
        self._learn([unit for unit in missing if unit not in self.young])
        return [self.young[unit] for unit in distinct]

    def encode(self, some: list[str]) -> list[bytes]:
        """Ids of each text. All texts are cut into units at once; the memo is asked once
        per distinct unit, and the ids are gathered from those."""
        parts = [text.encode() for text in some]
        data = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", dtype=np.uint8)
        lowered, firsts, lasts = units(data)
        kept = np.zeros(len(data), dtype=bool)
        kept[firsts] = True
        kept[lasts[lasts < len(data)]] ^= True
        kept = np.logical_xor.accumulate(kept)
        offsets = np.concatenate([[0], np.cumsum(lasts - firsts)]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lowered[kept])]
        found = pa.Array.from_buffers(pa.large_binary(), len(firsts), buffers).dictionary_encode()
        held, bounds = arrays.byte_runs(found.dictionary)
        held, bounds = held.tobytes(), bounds.tolist()
        known = self._known([held[a:b] for a, b in zip(bounds[:-1], bounds[1:])])
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        which = np.frombuffer(found.indices.buffers()[1], np.int32)[: len(firsts)]
        out = arrays.ragged_take(ids, np.cumsum(sizes) - sizes, sizes, which)
        text_units = np.searchsorted(firsts, np.cumsum([1, *(len(p) + 1 for p in parts)]))
        bounds = np.concatenate([[0], np.cumsum(sizes[which])])[text_units]
        return [out[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


_coders: dict[int, WordIds] = {}


def word_ids(tokenizer_json: str) -> WordIds:
    """One memo per worker process, which later tasks find again."""
    key = hash(tokenizer_json)
    if key not in _coders:
        _coders[key] = WordIds(tokenizer_json)
    return _coders[key]


SEGMENTS = "file int, first long, n_ids long, doc_ids array<long>, sizes binary, ids binary"
_SEGMENTS = pa.schema(
    [
        ("file", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("ids", pa.binary()),
    ]
)


def write(documents: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2) -> None:
    """Encode all documents into files below ``folder``, in ascending order of ``doc_id``."""
    if Path(tokenizer_path).stat().st_size > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_path} is too large to be sent to every executor")
    context = documents.sparkSession.sparkContext
    tokenizer = context.broadcast(Path(tokenizer_path).read_text())
    end = np.array([end_id], dtype="<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(tokenizer.value)
        file, first = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        coded: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            sizes = np.array([len(c) // 4 for c in coded], dtype=np.uint64)
            ids = np.frombuffer(b"".join(coded), dtype="<u4")
            row = {
                "file": file,
                "first": first,
                "n_ids": len(ids),
                "doc_ids": doc_ids,
                "sizes": pack(sizes),
                "ids": pack(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENTS)

        for batch in batches:
            ids, some = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at, group in shingles.groups(some, GROUP_CHARS):
                for doc_id, code in zip(ids[at : at + len(group)], coder.encode(group)):
                    doc_ids.append(doc_id)
                    coded.append(code + end)
                    held += len(coded[-1]) // 4
                    if held >= SEGMENT_IDS:
                        yield segment()
                        first += held
                        doc_ids, coded, held = [], [], 0
        if coded:
            yield segment()

    tie = F.xxhash64("text")
    ordered = texts(documents).withColumn("tie", tie).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(arrays.released(segments), SEGMENTS).write.parquet(folder)


DOCS = "doc_id long, start long, n_tokens long, ids binary"
_DOCS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids``; ids are little-endian unsigned 32-bit
    integers, and ``start`` counts the ids of all documents before."""
    ship(spark)
    stored = spark.read.schema(SEGMENTS).parquet(folder)
    # One row per file: the sum over all files before is over a short list.
    files = stored.groupBy("file").agg(F.sum("n_ids").alias("in_file"))
    before = F.sum("in_file").over(Window.orderBy("file")) - F.col("in_file")
    placed = stored.join(files.select("file", before.alias("base")), "file")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["ids"]).astype("<u4")
                sizes = unpack(row["sizes"]).astype(np.int64)
                ends = np.cumsum(sizes)
                starts = (ends - sizes).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["first"] + s for s in starts], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    schema=_DOCS,
                )

    return placed.select(
        (F.col("base") + F.col("first")).alias("first"), "doc_ids", "sizes", "ids"
    ).mapInArrow(arrays.released(rows), DOCS)
