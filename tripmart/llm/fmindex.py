"""A compressed full-text index over word ids: backward search by a wavelet matrix."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words, with the ones before each word counted."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(ones[:-1]))).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FmIndex:
    """Index of a sequence of ids (0 only as separator) for patterns of up to ``depth`` ids.

    Suffixes are sorted by their first ``depth`` ids, which is all that patterns of that length
    need.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        n = len(text)
        rank, known = text.astype(np.int64), 1
        while 2 * known < depth:
            rank = self._dense(self._pairs(rank, known))
            known *= 2
        key = self._pairs(rank, depth - known)
        self.suffixes = np.argsort(key, kind="stable")
        ordered = key[self.suffixes]
        shorter = self._pairs(rank, depth - 1 - known)[self.suffixes]
        #: per suffix in order: its class by ``depth`` ids, the earliest place of each class
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        self.kind = np.cumsum(new) - 1
        self.earliest = np.minimum.reduceat(self.suffixes, np.flatnonzero(new))
        #: per suffix in order: bounds of the suffixes that agree in ``depth`` - 1 ids
        new = np.concatenate(([True], shorter[1:] != shorter[:-1]))
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        self.low = starts[group]
        self.high = np.append(starts[1:], n)[group]

        last = text[self.suffixes - 1]
        self.levels = max(1, int(text.max()).bit_length())
        self.bits, self.zeros = [], []
        own = last
        for level in range(self.levels - 1, -1, -1):
            one = ((own >> level) & 1).astype(bool)
            self.bits.append(BitVector(one))
            self.zeros.append(len(own) - int(one.sum()))
            own = np.concatenate((own[~one], own[one]))
        ids = np.arange(int(text.max()) + 1)
        smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(ids)))[:-1]))
        #: per id: suffixes that begin with a smaller one, less where its run begins at the end
        self.base = smaller - self._descend(ids, np.zeros(len(ids), np.int64))

    @staticmethod
    def _pairs(rank: np.ndarray, step: int) -> np.ndarray:
        after = np.zeros_like(rank)
        after[: len(rank) - step] = rank[step:]
        return rank * (int(rank.max()) + 1) + after

    @staticmethod
    def _dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        return rank

    def _descend(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.zeros, strict=True):
            ones = bits.rank(at)
            at = np.where((ids >> level) & 1, zeros + ones, at - ones)
        return at

    def extend(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns that put ``ids`` before those of the given intervals."""
        both = self._descend(np.concatenate((ids, ids)), np.concatenate((low, high)))
        both += self.base[np.concatenate((ids, ids))]
        return both[: len(ids)], both[len(ids) :]


def earliest_occurrences(index: FmIndex, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """For every place where ``depth`` ids of a streamed piece begin: their first place in the text.

    Pieces are streamed from their ends, all at once, a step of backward search at a time. As
    soon as ``depth`` ids are matched, the interval is widened to one id less before the next
    step. Yields (piece numbers, offset in the piece, earliest place).
    """
    depth = index.depth
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    low = np.zeros(len(order), np.int64)
    high = np.full(len(order), len(text), np.int64)
    for step in range(int(lengths.max(initial=0))):
        active = int(np.searchsorted(-lengths, -step, "left"))  # longer than step
        at = lengths[:active] - 1 - step
        l, h = low[:active], high[:active]
        if step >= depth:
            l, h = index.low[l], index.high[l]
        low[:active], high[:active] = index.extend(text[starts[:active] + at], l, h)
        if step >= depth - 1:
            yield order[:active], at, index.earliest[index.kind[low[:active]]]
