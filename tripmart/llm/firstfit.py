"""Operator 13: pack token sequences by first fit decreasing in randomised groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, keyed, written
from tripmart.llm.packing import encoder

# Documents of a group on average. A group's ends are at most this many times ``capacity`` ids.
GROUP_DOCS = 4096

_CUT = "row long, doc_id long, start long, length long, doc_tokens long, ids binary"
_CUT_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("row", "doc_id", "start", "length", "doc_tokens")] + [("ids", pa.binary())]
)
_PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_PACKED_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)


class CapacityTree:
    """A tournament tree over bins: every inner node holds the largest room below it."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1
        while self.size < bins:
            self.size *= 2
        self.room = [capacity] * (2 * self.size)

    def take(self, length: int) -> tuple[int, int]:
        """Put ``length`` in the first bin with room for it; returns the bin and its room before."""
        room, at = self.room, 1
        while at < self.size:
            at *= 2
            if room[at] < length:
                at += 1
        before = room[at]
        room[at] -= length
        bin_, at = at - self.size, at // 2
        while at:
            larger = max(room[2 * at], room[2 * at + 1])
            if room[at] == larger:
                break
            room[at] = larger
            at //= 2
        return bin_, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items by bin: longest first (ties by place), each in the first bin that has room."""
    tree = CapacityTree(len(lengths), capacity)
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at, _ = tree.take(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def close_gaps(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins as parts (item, from, length), without padding.

    What the emptiest bins hold fills the gaps of the fullest, whole parts first, the last one cut
    to fit. The bin in which both ends meet is cut into parts whose lengths are powers of two.
    """
    parts = [[(i, 0, lengths[i]) for i in items] for items in bins]
    room = [capacity - sum(n for *_, n in p) for p in parts]
    order = sorted(range(len(parts)), key=lambda b: (room[b], b))
    fill, give = 0, len(order) - 1
    while fill < give:
        into, out = order[fill], order[give]
        if not room[into]:
            fill += 1
            continue
        if not parts[out]:
            give -= 1
            continue
        item, start, n = parts[out].pop()
        moved = min(n, room[into])
        if moved < n:
            parts[out].append((item, start, n - moved))
        parts[into].append((item, start + n - moved, moved))
        room[into] -= moved
        room[out] += moved
    done = [parts[b] for b in order[:give] if parts[b]]
    if order:
        done += _powers(parts[order[give]])
    return done


def _powers(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The parts dealt over sequences whose lengths are the powers of two in their sum."""
    left = sum(n for *_, n in parts)
    parts, found = parts[::-1], []
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        sequence = []
        while size:
            item, start, n = parts.pop()
            moved = min(n, size)
            if moved < n:
                parts.append((item, start + moved, n - moved))
            sequence.append((item, start, moved))
            size -= moved
        found.append(sequence)
    return found


def _tokens(docs: DataFrame, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """Whole sequences of each document and what is left of it, with their ids (32 bits each)."""
    last = np.array([end], "<u4").tobytes()

    def cut(batches):
        encode = encoder(tokenizer)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in batch_chunks(batch):
                ids = encode([t or "" for t in chunk.column(1).to_pylist()])
                rows = []
                for doc, own in zip(chunk.column(0).to_pylist(), ids, strict=True):
                    own += last
                    n = len(own) // 4
                    for a in range(0, n, capacity):
                        row += 1
                        part = own[4 * a : 4 * (a + capacity)]
                        rows.append((row, doc, a, len(part) // 4, n, part))
                yield arrays(_CUT_SCHEMA, *zip(*rows, strict=True))

    return keyed(docs).select("doc_id", "text").mapInArrow(cut, _CUT)


def _pack_group(capacity: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        (group,) = key
        table = table.sort_by("row")
        doc, start, length, total, ids = (
            table.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids")
        )
        bins = close_gaps(first_fit_decreasing(length, capacity), length, capacity)
        rows = []
        for k, parts in enumerate(bins):
            offset = 0
            for i, a, n in parts:
                own = ids[i][4 * a : 4 * (a + n)]
                # groups count in odd numbers, whole sequences in even ones
                sequence = 2 * ((group.as_py() << 24) + k) + 1
                rows.append((doc[i], start[i] + a, n, total[i], sequence, offset, own))
                offset += n
        return pa.Table.from_batches([arrays(_PACKED_SCHEMA, *zip(*rows, strict=True))])

    return pack


def pack_first_fit(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 4096,
    end: int = 2,
    group_docs: int = GROUP_DOCS,
    seed: int = 13,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids without padding.

    A document is the ids of its text and then ``end``; a null text is empty, that is one id.
    Repeated rows are packed each on their own. Other columns do not matter; an empty table gives
    no rows. Returns, per piece, doc_id, start, length, doc_tokens, sequence_id, offset and
    ``ids``, the piece's ids as little-endian 32-bit numbers.

    Whole sequences of long documents stay where they are. What is left of each document (fewer
    than ``capacity`` ids) goes, by a hash of its row, to one of as many groups as make
    ``group_docs`` documents on average, however many share an id or a text. A group is packed by
    first fit decreasing over a tournament tree of bin capacities. Then its emptiest bins fill the
    gaps of the others, which cuts about a piece for each gap, and the bin left over is cut at
    powers of two, which need no padding.
    """
    cut = written(_tokens(docs, tokenizer, capacity, end), "token-pieces")
    whole = cut.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", "doc_tokens", (2 * F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids",
    )
    rest = cut.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_docs))
    group = F.pmod(F.xxhash64(F.col("row"), F.lit(seed)), F.lit(groups))
    packed = rest.withColumn("group", group).groupBy("group").applyInArrow(_pack_group(capacity), _PACKED)
    return whole.unionByName(packed)
