"""Hashed character n-grams and words of many texts at once, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd 64-bit multipliers that mix code points by place.
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each text between two spaces, and where each begins."""
    joined = "".join(f" {t} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 2 for t in texts])
    return points, starts


def letters_only(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is no letter becomes a space, and runs of spaces become one."""
    points = np.where(_letters()[points], points, SPACE)
    space = points == SPACE
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts[:-1]] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return points[keep], before[starts]


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` code points from each place on."""
    p = points.astype(np.uint64) + np.uint64(n << 24)
    total = p[: len(p) - n + 1] * _MIX[0]
    for i in range(1, n):
        total += p[i : len(p) - n + 1 + i] * _MIX[i]
    total ^= total >> np.uint64(29)
    return total * _MIX[2]


def word_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs between spaces, line ends and tabs, and where each begins."""
    blank = (points == SPACE) | ((points >= 9) & (points <= 13))
    first = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(first):
        return np.zeros(0, np.uint64), first
    run = np.cumsum(~blank & np.concatenate(([True], blank[:-1])))
    place = np.arange(len(points)) - first[np.maximum(run, 1) - 1]
    powers = np.multiply.accumulate(np.full(64, _MIX[0]))
    mixed = np.where(blank, np.uint64(0), (points + np.uint64(1)) * powers[place & 63])
    total = np.add.reduceat(mixed, first)
    total ^= total >> np.uint64(31)
    return total * _MIX[1], first
