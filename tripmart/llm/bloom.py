"""A pair of Bloom filters over all rows: hashes seen once, and hashes seen twice or more.

Tasks ship what they would insert, cut by segment; the owner of a segment replays the inserts
into the two filters. Every hash has its four bits in one 64-bit word, so a segment is a range
of words. A hash inserted by two rows always sets all its bits in the second filter; another
hash may, with a probability that the filter's size sets. So the filter names suspects only,
and whoever uses it confirms them exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import arrays, shuffle_tasks, written_at
from tripmart.paths import delete
from tripmart.session import scratch_path

# Bits of the second filter that tasks may hold at most: 32 MiB. Beyond about 2**28 / 16
# keys the filter grows denser and more rows become suspects; none is missed.
MAX_LOG2_BITS = 28
BITS_PER_KEY = 16
SEGMENTS = 64

INSERTS = "segment int, n long, hashes binary"
_INSERTS = pa.schema([("segment", pa.int32()), ("n", pa.int64()), ("hashes", pa.binary())])
_SEGMENT = pa.schema([("segment", pa.int32()), ("twice", pa.binary())])


def inserts(hashes: np.ndarray) -> pa.RecordBatch:
    """Rows of ``INSERTS`` for a batch's hashes; repeats count as seen twice."""
    hashes = np.sort(hashes)
    # of each hash two copies are enough
    keep = np.ones(len(hashes), bool)
    keep[2:] = hashes[2:] != hashes[:-2]
    hashes = hashes[keep]
    segment = (hashes >> np.uint64(64 - 6)).astype(np.int64)
    bounds = np.searchsorted(segment, np.arange(SEGMENTS + 1))
    full = np.flatnonzero(np.diff(bounds))
    return arrays(
        _INSERTS,
        full.astype(np.int32),
        np.diff(bounds)[full],
        [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in full],
    )


def _place(hashes: np.ndarray, log2_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit mask of each hash."""
    one, low = np.uint64(1), np.uint64(63)
    mask = one << (hashes & low)
    for shift in (6, 12, 18):
        mask |= one << ((hashes >> np.uint64(shift)) & low)
    return (hashes >> np.uint64(64 - log2_words)).astype(np.int64), mask


def seen_twice(table: DataFrame) -> np.ndarray:
    """The second filter over a written table of ``INSERTS``."""
    n = table.agg({"n": "sum"}).first()[0] or 0
    log2_words = min(MAX_LOG2_BITS, max(16, int(BITS_PER_KEY * n).bit_length())) - 6
    size = 1 << (log2_words - 6)

    def replay(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if s not in once:
                    once[s], twice[s] = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                word, mask = _place(np.frombuffer(blob, np.uint64), log2_words)
                word -= s * size
                # equal neighbours are one hash inserted twice; the hashes are sorted
                hashes = np.frombuffer(blob, np.uint64)
                again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
                np.bitwise_or.at(twice[s], word[again], mask[again])
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                merged, at = np.bitwise_or.reduceat(mask, starts), word[starts]
                twice[s][at] |= once[s][at] & merged
                once[s][at] |= merged
        for s, bits in twice.items():
            yield arrays(_SEGMENT, [s], [bits.tobytes()])

    spark = table.sparkSession
    parts = min(SEGMENTS, shuffle_tasks(spark))
    rows = (
        table.select("segment", "hashes")
        .repartition(parts, "segment")
        .mapInArrow(replay, "segment int, twice binary")
        .collect()
    )
    filter_ = np.zeros(size * SEGMENTS, np.uint64)
    for row in rows:
        filter_[row.segment * size : (row.segment + 1) * size] = np.frombuffer(bytes(row.twice), np.uint64)
    return filter_


def repeats(rows: DataFrame, name: str) -> tuple[np.ndarray, int]:
    """The second filter over rows of ``INSERTS``, and how many inserts there were.

    The inserts are written, as their number sizes the filter, and deleted once it is made.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    table = written_at(rows, path)
    n = table.agg({"n": "sum"}).first()[0] or 0
    found = seen_twice(table)
    delete(spark, path)
    return found, n


def suspects(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word, mask = _place(hashes, len(filter_).bit_length() - 1)
    return (filter_[word] & mask) == mask
