"""A fixed public vocabulary of text pieces, and where its pieces occur in a batch of texts.

Occurrences come from a suffix array of the batch's distinct text units (no piece is
longer than 16 characters, so suffixes are ordered by their first 16): every piece is
binary-searched for its range of suffixes, and the ranges' positions are the edges of a
lattice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

SPACE = "▁"
DEPTH, _BITS, _PACK = 16, 15, 4
_INF = np.iinfo(np.int64).max


def default_path() -> str:
    """The model file of the public tokenizers that are installed beside Python."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces with their ids, merge ranks (-1: one character) and the two parts each
    was merged from. Bounded by the vocabulary file; the same for every input."""
    text: list[str]
    ids: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    reachable: np.ndarray
    pair_keys: np.ndarray
    pair_rank: np.ndarray
    byte_ids: np.ndarray
    run_ids: dict[int, int]
    size: int

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.text], np.int32)


def load(path: str | None = None) -> Vocabulary:
    """Read a SentencePiece BPE model with byte fallback. Driver only."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    text, ids, score, runs = [], [], [], {}
    byte_ids = np.full(256, model.unk_id())
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if len(p) > 1 and not p.strip(SPACE):
                runs[len(p)] = i
            else:
                text.append(p)
                ids.append(i)
                score.append(model.get_score(i))
    if max(map(len, text)) > DEPTH:
        raise ValueError(f"pieces longer than {DEPTH} characters")
    runs[1] = ids[text.index(SPACE)]
    place = {p: k for k, p in enumerate(text)}
    n = len(text)
    long = np.array([len(p) > 1 for p in text])
    rank = np.full(n, -1, np.int64)
    _, rank[long] = np.unique(-np.array(score)[long], return_inverse=True)
    merges: dict[tuple[int, int], int] = {}
    for k, p in enumerate(text):
        for cut in range(1, len(p)):
            a, b = place.get(p[:cut]), place.get(p[cut:])
            if a is not None and b is not None:
                merges[a, b] = k
    left, right, reachable = np.arange(n), np.arange(n), np.ones(n, bool)
    for k, p in enumerate(text):
        if len(p) > 1:
            parts, last = merge([place.get(c, -1) for c in p], merges, rank)
            reachable[k] = parts == [k]
            if reachable[k]:
                left[k], right[k] = last
    keys = np.array([a * n + b for a, b in merges], np.int64)
    order = np.argsort(keys)
    return Vocabulary(text, np.array(ids, np.int32), rank, left, right, reachable, keys[order],
                      rank[np.array(list(merges.values()))][order], byte_ids.astype(np.int32), runs,
                      model.get_piece_size())


def merge(parts: list[int], merges: dict, rank: np.ndarray) -> tuple[list[int], tuple[int, int] | None]:
    """Byte-pair merging by the definition: the lowest rank first, leftmost on ties.
    Returns the parts and the last pair that was merged."""
    last = None
    while True:
        found = [(rank[merges[a, b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
        if not found:
            return parts, last
        i = min(found)[1]
        last = parts[i], parts[i + 1]
        parts = [*parts[:i], merges[last], *parts[i + 2:]]


class Matcher:
    """Finds all occurrences of a vocabulary's pieces."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        chars = sorted({c for p in v.text for c in p})
        if len(chars) >= 1 << _BITS:
            raise ValueError("too many characters")
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.lengths = v.lengths
        codes = np.zeros((len(v.text), DEPTH), np.int64)
        for k, p in enumerate(v.text):
            codes[k, :len(p)] = self.classes[[ord(c) for c in p]]
        inside = np.arange(DEPTH) < self.lengths[:, None]
        self.low = self._pack(codes)
        self.high = self._pack(np.where(inside, codes, (1 << _BITS) - 1))

    @staticmethod
    def _pack(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), DEPTH // _PACK), np.int64)
        for i in range(DEPTH):
            out[:, i // _PACK] |= codes[:, i] << (_BITS * (_PACK - 1 - i % _PACK))
        return out

    def codes(self, text: str) -> np.ndarray:
        """The class of each character; 0 for those that no piece has."""
        return self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece index) of every occurrence of every piece, by piece."""
        n = len(codes)
        padded = np.concatenate([codes.astype(np.int64), np.zeros(2 * DEPTH, np.int64)])
        pack = np.zeros(n + DEPTH, np.int64)
        for i in range(_PACK):
            pack |= padded[i:i + n + DEPTH] << (_BITS * (_PACK - 1 - i))
        key, width = pack, _PACK
        while width < DEPTH:
            rank = np.unique(key, return_inverse=True)[1]
            key = rank << 32
            key[:-width] |= rank[width:]
            width *= 2
        order = np.argsort(key[:n])
        keys = [pack[order + j] for j in range(0, DEPTH, _PACK)]
        lo, hi = self._first(keys, self.low, False), self._first(keys, self.high, True)
        count = hi - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return order[at], np.repeat(np.arange(len(count)), count)

    @staticmethod
    def _first(keys: list[np.ndarray], target: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of all targets: the first suffix not below (``after``: above) each."""
        n = len(keys[0])
        lo, hi = np.zeros(len(target), np.int64), np.full(len(target), n)
        for _ in range(n.bit_length() if n else 0):
            mid = (lo + hi) >> 1
            at = np.minimum(mid, n - 1)
            below, same = np.zeros(len(target), bool), np.ones(len(target), bool)
            for j, k in enumerate(keys):
                v = k[at]
                below |= same & (v < target[:, j])
                same &= v == target[:, j]
            below = (below | same if after else below) & (mid < hi)
            lo, hi = np.where(below, mid + 1, lo), np.where(below | (mid >= hi), hi, mid)
        return lo


def by_end(start: np.ndarray, length: np.ndarray, unit_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of edges by the distance of their end from the unit's start (then by length), and
    the bounds of the runs of equal (distance, length): within one all ends differ."""
    key = (start - unit_start + length) * (DEPTH + 1) + length
    top = int(key.max(initial=0))
    key = key.astype(np.uint16 if top < 65_536 else np.int64)
    order = np.argsort(key, kind="stable")
    bounds = np.flatnonzero(np.diff(key[order], prepend=key.dtype.type(0))) if len(key) else np.zeros(0, np.int64)
    return order, np.unique(np.concatenate([[0], bounds, [len(key)]]))


def unit_starts(units: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of units in their newline-ended concatenation, and the unit of each character."""
    lengths = np.fromiter(map(len, units), np.int64, len(units)) + 1
    starts = np.cumsum(lengths) - lengths
    return starts, np.repeat(starts, lengths)
