"""Numpy over variable-length values: hashes of byte runs, ragged gathers, packed integers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 19
TAKE = 1 << 17
_powers: dict[str, np.ndarray] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system: Spark keeps idle workers for a while, and
    several of them share an executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def released(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that gives its memory back at the end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from rows(batches)
        finally:
            release()

    return run


def freed(function: Callable[..., pa.Table], *groups: pa.Table) -> pa.Table:
    """The function's result for one group; what it held besides goes back at once."""
    try:
        return function(*groups)
    finally:
        release()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str) -> np.ndarray:
    if name not in _powers:
        base = BASE if name == "up" else pow(BASE, -1, 1 << 64)
        steps = np.full(CHUNK + 1, base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name]


def _short_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of byte times power of the place in the run; the runs span at most CHUNK bytes."""
    low, high = int(starts[0]), int(ends[-1])
    terms = (data[low:high].astype(np.uint64) + np.uint64(1)) * _power("up")[: high - low]
    sums = np.zeros(high - low + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    return (sums[ends - low] - sums[starts - low]) * _power("down")[starts - low]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:end]``; runs are in ascending order.
    Equal runs hash alike wherever they stand."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        stop = int(np.searchsorted(ends, starts[at] + CHUNK, side="right"))
        if stop > at:
            out[at:stop] = _short_runs(data, starts[at:stop], ends[at:stop])
        else:  # one run longer than a chunk: piece by piece
            stop, total, factor = at + 1, np.uint64(0), np.uint64(1)
            with np.errstate(over="ignore"):
                for low in range(int(starts[at]), int(ends[at]), CHUNK):
                    high = np.array([min(low + CHUNK, int(ends[at]))])
                    total += _short_runs(data, np.array([low]), high)[0] * factor
                    factor *= _power("up")[CHUNK]
            out[at] = total
        at = stop
    lengths = (ends - starts).astype(np.uint64)
    return mix(out + lengths * np.uint64(0xD1B54A32D192ED03))


def byte_runs(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array without nulls."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)
    offsets = offsets[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    low = int(offsets[0]) if len(offsets) else 0
    high = int(offsets[-1]) if len(offsets) else 0
    return data[low:high], offsets - low


def hashes(values: pa.Array) -> np.ndarray:
    data, offsets = byte_runs(values)
    return run_hashes(data, offsets[:-1], offsets[1:])


def ragged_take(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray
) -> np.ndarray:
    """``data[start:start+length]`` of every entry of ``which``, one after the other. Places
    are worked out for TAKE values at a time, as they are wider than most data."""
    ends = np.cumsum(lengths[which], dtype=np.int64)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=data.dtype)
    low = 0
    while low < len(ends):
        first = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, first + TAKE, side="right")))
        last = int(ends[high - 1])
        if high == low + 1:
            start = int(starts[which[low]])
            out[first:last] = data[start : start + last - first]
        else:
            part = which[low:high]
            sizes = lengths[part]
            before = ends[low:high] - sizes
            places = np.repeat(starts[part] - before, sizes)
            places += np.arange(first, last)
            out[first:last] = data[places]
        low = high
    return out


def compressed(values: np.ndarray, width: int = 4) -> bytes:
    """Integers by byte planes, so that the mostly empty high bytes cost next to nothing.
    Raises if a value does not fit into ``width`` bytes."""
    if len(values) and (values.min() < 0 or int(values.max()) >> 8 * width):
        raise OverflowError(f"values beyond {width} bytes")
    wide = np.ascontiguousarray(values, dtype=f"<u{width}")
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def expanded(packed: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()
