"""Words of texts as 64-bit hashes, and Karp-Rabin hashes of windows of words.

A word is a run of ASCII letters and digits and of characters beyond ASCII, in lower case;
everything else separates words. All work is on the bytes of many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm import arrays

GROUP_CHARS = 1 << 20
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[128:] = True
for _low, _high in ("az", "09"):
    _IS_WORD[ord(_low) : ord(_high) + 1] = True


def groups(
    texts: list[str | None], limit: int = GROUP_CHARS, most: int = 1 << 20
) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about ``limit`` characters and at most ``most`` texts, one text at
    least, with the place of the first; a null text as the empty one."""
    first, held, size = 0, [], 0
    for place, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1])
        if size >= limit or len(held) >= most:
            yield first, held
            first, held, size = place + 1, [], 0
    if held:
        yield first, held


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the bounds of each text among them."""
    parts = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    inside = np.concatenate([[False], _IS_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    found = arrays.run_hashes(data, starts, ends)
    text_starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return found, np.searchsorted(starts, text_starts)


def windows(words: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``length`` words of every text, and each text's bounds
    among them. A text with fewer words has none."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    rolled = np.zeros(n, dtype=np.uint64)
    for place in range(length):
        rolled = rolled * np.uint64(arrays.BASE) + words[place : place + n]
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    inside = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(bounds[:-1] - inside[:-1], sizes) + np.arange(inside[-1])
    return arrays.mix(rolled[places]), inside
