"""Word shingles as 64-bit hashes, computed for many texts at once with numpy.

Words are maximal runs of letters and digits of the lower-cased text: ASCII letters
and digits, and every character outside ASCII. A text of fewer words than a shingle
has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and per text the offset of its first word
    (one more entry at the end)."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    inside = _IS_WORD[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # texts end in a separator
    offsets = np.concatenate([[0], np.searchsorted(starts, ends)])
    if not len(starts):
        return np.zeros(0, np.uint64), offsets
    length = stops - starts
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    power = np.ones(length.max(), np.uint64)
    power[1:] = _BASE
    power = np.multiply.accumulate(power)
    value = (data[inside].astype(np.uint64) + np.uint64(1)) * power[place]
    return mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64)), offsets


def shingle_hashes(texts: Sequence[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, repeats included, and the offsets of each text's."""
    h, at = word_hashes(texts)
    n = np.diff(at)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(at[:-1], count) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], count)
    out = np.zeros(offsets[-1], np.uint64)
    padded = np.concatenate([h, np.zeros(words, np.uint64)])
    size = np.repeat(np.minimum(n, words), count)
    for k in range(words):
        out = out * _BASE + np.where(k < size, padded[first + k], np.uint64(0))
    return mix(out), offsets
