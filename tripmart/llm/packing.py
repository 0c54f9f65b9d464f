"""Operator 5: pack documents into as few token sequences as best fit can."""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, keyed, shuffle_tasks, written

# Words of which a Python worker remembers the ids.
CACHED_WORDS = 300_000

# Pieces and gaps, together, that one range of a superstep aims at; as few as that are left to
# one task.
RANGE_ROWS = 16_384

# The vocabulary file's rule for splitting text, and what ends a document.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = np.array([1], "<u4").tobytes()

# Texts in which splitting into words ourselves could differ from the tokenizer's own rule:
# special tokens, characters that another Unicode version may class otherwise, and
# compositions. They are handed over whole.
_PLAIN = re.compile("[\t-\r -~\u00a0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u2010-\u2027\u20ac]*\\Z")

# Of each UTF-8 byte: 1 an ASCII mark, 2 a comma or full stop, 4 it may begin another mark.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[x for x in range(33, 127) if not chr(x).isalnum()]] = 1
_KINDS[[ord(","), ord(".")]] = 3
_KINDS[[0xC2, *range(0xE0, 0xF5)]] = 4

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("copy", pa.int64()), ("piece", pa.int32()),
     ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)

# After a sweep: pieces that have their place, pieces that found no gap in their range (by
# rank), gaps that every later range can use (by rank, smallest first), other gaps.
PLACED, WAITING, REACHED, LATER = range(4)
_SWEPT = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()),
     ("offset", pa.int64()), ("state", pa.int32()), ("task", pa.int32()), ("rank", pa.int64())]
)
_SWEPT_DDL = (
    "row long, doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long, state int, task int, rank long"
)
_OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class _Known(dict):
    """Ids of words as little-endian bytes, kept for the first ``CACHED_WORDS`` words met.

    A run of characters without white space that is not one word is put together from words.
    """

    def __init__(self, tokenize, point: dict[int, str]):
        self.tokenize, self.point = tokenize, point

    def __missing__(self, run: str) -> bytes:
        words = [run] if run.isalpha() else WORDS.findall(run)
        if len(words) == 1:
            ids = [t.id for t in self.tokenize(run.encode().decode("latin-1").translate(self.point))]
            value = struct.pack(f"<{len(ids)}I", *ids)
        else:
            value = b"".join([self[w] for w in words])
        if len(self) < CACHED_WORDS:
            self[run] = value
        return value


class Encoder:
    """Ids of a text as little-endian bytes.

    Words are encoded apart from each other, so the ids of a text are those of its words, and
    words come again and again.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # the character that stands for each byte in the vocabulary
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        point = {x: level.pre_tokenize_str(chr(x))[0][0] for x in range(128)}
        point |= {0xC0 | x >> 6: level.pre_tokenize_str(chr(x))[0][0][0] for x in range(128, 2048, 64)}
        point |= {0x80 | x & 63: level.pre_tokenize_str(chr(x))[0][0][1] for x in range(128, 192)}
        point |= {0xE0 | x >> 12: level.pre_tokenize_str(chr(x))[0][0][0] for x in range(0x1000, 0x10000, 0x1000) if x >> 11 != 27}
        point[0xE0] = level.pre_tokenize_str(chr(0x800))[0][0][0]
        self.known = _Known(self.tokenizer.model.tokenize, point)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        return list(map(self._ids, texts, _clustered(texts)))

    def _ids(self, text: str, clustered: bool) -> bytes:
        if "<|" in text or not _PLAIN.match(text):
            return self.whole(text)
        text = text.lower()
        if not clustered:  # then each comma and each full stop is a word
            text = text.replace(",", " , ").replace(".", " . ")
        return b"".join(map(self.known.__getitem__, text.split()))


def _clustered(texts: list[str]) -> list[bool]:
    """Texts in which a comma or full stop may be one word with another mark next to it."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    kind = _KINDS[data]
    at = np.flatnonzero((kind[1:] & kind[:-1] & 1) * ((kind[1:] | kind[:-1]) & 2) | (kind[:-1] & 4))
    ends = np.cumsum([len(x) + 1 for x in parts])
    found = np.zeros(len(parts), bool)
    found[np.searchsorted(ends, at, "right")] = True
    return found.tolist()


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Token pieces of each document: ids, then id 1, cut every ``capacity`` ids.

    Rows that repeat a document are numbered by ``copy``, in no order of their own.
    """

    def cut(batches):
        encode = encoder(tokenizer)
        copy = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk in batch_chunks(batch):
                ids = encode([t or "" for t in chunk.column(1).to_pylist()])
                rows = []
                for d, k, x in zip(chunk.column(0).to_pylist(), chunk.column(2).to_pylist(), ids, strict=True):
                    copy += 1
                    x += END
                    n = len(x) // 4
                    for i, a in enumerate(range(0, n, capacity)):
                        b = min(n, a + capacity)
                        rows.append((d, k, copy, i, a, b - a, zlib.crc32(x[4 * a : 4 * b])))
                yield arrays(_PIECES, *zip(*rows, strict=True))

    return keyed(docs).mapInArrow(
        cut,
        "doc_id long, text_key long, copy long, piece int, start long, length long, ids_crc32 long",
    )


def sweep(rows: DataFrame, capacity: int, tasks: int, first_new: int | None = None) -> DataFrame:
    """One sweep over pieces and gaps, longest first: every piece with what became of it.

    Rows are range-sorted over ``tasks``. Each task goes down its range: a piece takes the smallest
    gap met so far, which is its successor; a gap that shrinks comes back at its new size.
    With ``first_new``, all rows are one range, and a piece without a gap opens a sequence, with
    ids from there downwards.
    """
    order = [F.desc("length"), F.desc("gap"), "row"]
    one = first_new is not None
    ranged = rows.coalesce(1) if one else rows.repartitionByRange(tasks, *order)

    def down(batches):
        task, waiting, opened = TaskContext.get().partitionId(), 0, 0
        reached: list[list[int]] = []  # [gap, sequence], the smallest last
        later: list[tuple[int, int]] = []  # (-gap, sequence) of gaps the sweep has yet to come to
        for batch in batches:
            size, gap, row = (batch.column(c).to_pylist() for c in ("length", "gap", "row"))
            sequence, offset, rank = [], [], []
            for n, is_gap, number in zip(size, gap, row, strict=True):
                while later and -later[0][0] >= n:
                    reached.append([-later[0][0], heapq.heappop(later)[1]])
                if is_gap:
                    reached.append([n, number])
                    continue
                if not reached and one:
                    reached.append([capacity, first_new - opened])
                    opened += 1
                if not reached:
                    sequence.append(None), offset.append(None), rank.append(waiting)
                    waiting += 1
                    continue
                least = reached[-1]
                sequence.append(least[1]), offset.append(capacity - least[0]), rank.append(None)
                least[0] -= n
                if least[0] < n:
                    reached.pop()
                    if least[0]:
                        heapq.heappush(later, (-least[0], least[1]))
            part = batch.filter(pc.invert(batch.column("gap")))
            yield arrays(
                _SWEPT, *part.columns[:6], sequence, offset,
                [PLACED if s is not None else WAITING for s in sequence], [task] * len(sequence), rank,
            )
        left = [(g, s, REACHED, i) for i, (g, s) in enumerate(reversed(reached))]
        left += [(-g, s, LATER, None) for g, s in later]
        for at in range(0, len(left), 10_000):
            size, sequence, state, rank = zip(*left[at : at + 10_000], strict=True)
            none = [None] * len(size)
            yield arrays(
                _SWEPT, none, none, none, none, size, none, sequence, none, state, [task] * len(size), rank
            )

    return ranged.sortWithinPartitions(*order).mapInArrow(down, _SWEPT_DDL)


def deal(ranges: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of the pieces that wait get which ranks of the gaps that are left.

    ``ranges``: task, pieces waiting, the longest of them, gaps reached, the smallest of those. Ranges
    go from long to short. Those that wait take the smallest gaps of longer ranges, each gap as many
    of them as fit for certain. Returns (task, first rank, end rank, pieces per gap, task of the
    gaps, first rank of the gaps); twice as many rows as ranges at most.
    """
    left: list[list[int]] = []  # [task, first rank, gaps, smallest], the smallest last
    dealt = []
    for task, waiting, longest, gaps, smallest in sorted(ranges):
        rank = 0
        while rank < waiting and left:
            source = left[-1]
            each = source[3] // longest
            end = min(waiting, rank + source[2] * each)
            dealt.append((task, rank, end, each, source[0], source[1]))
            used = -(-(end - rank) // each)
            source[1] += used
            source[2] -= used
            if not source[2]:
                left.pop()
            rank = end
        if gaps:
            left.append([task, 0, gaps, smallest])
    return dealt


def _superstep(rows: DataFrame, capacity: int, tasks: int) -> tuple[list[DataFrame], DataFrame]:
    """Placements of one sweep and of what its ranges then deal each other, and the rows left."""
    spark = rows.sparkSession
    swept = written(sweep(rows, capacity, tasks), "packing-sweep")
    waits, reached = F.col("state") == WAITING, F.col("state") == REACHED
    # one row for each range
    ranges = (
        swept.where(waits | reached)
        .groupBy("task")
        .agg(
            F.count(F.when(waits, 1)), F.max(F.when(waits, F.col("length"))),
            F.count(F.when(reached, 1)), F.min(F.when(reached, F.col("length"))),
        )
    )
    dealt = spark.createDataFrame(
        deal([tuple(x or 0 for x in r) for r in ranges.collect()]),
        "task int, first long, end long, each long, gap_task int, gap_first long",
    )
    waiting = swept.where(waits).join(
        F.broadcast(dealt.withColumnRenamed("task", "to")),
        (F.col("task") == F.col("to")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
        "left",
    )
    pieces_left = waiting.where("to is null").select(
        "row", "doc_id", "piece", "start", "length", "ids_crc32", F.lit(False).alias("gap")
    )
    of_gap = ["gap_task", "gap_rank"]
    before = Window.partitionBy(*of_gap).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    given = waiting.where("to is not null").select(
        "row", "doc_id", "piece", "start", "length", "ids_crc32", "rank", "gap_task",
        F.expr("gap_first + (rank - first) div each").alias("gap_rank"),
    )
    given = given.withColumn("before", F.coalesce(F.sum("length").over(before), F.lit(0)))
    gaps = swept.where(reached).select(
        F.col("task").alias("gap_task"), F.col("rank").alias("gap_rank"),
        F.col("length").alias("size"), "sequence_id",
    )
    placed = written(
        given.join(gaps, of_gap).withColumn("offset", capacity - F.col("size") + F.col("before")).select(*_OUT),
        "packing-dealt",
    )
    taken = placed.groupBy("sequence_id").agg(F.sum("length").alias("taken"))
    gaps_left = (
        swept.where((F.col("state") == REACHED) | (F.col("state") == LATER))
        .join(taken, "sequence_id", "left")
        .select("sequence_id", (F.col("length") - F.coalesce("taken", F.lit(0))).alias("length"))
    )
    left = written(pieces_left.unionByName(_gap_rows(gaps_left)), "packing-left")
    return [swept.where(F.col("state") == PLACED).select(*_OUT), placed], left


def _gap_rows(gaps: DataFrame) -> DataFrame:
    """Rows of a superstep for the sequences of ``gaps`` (sequence_id, length)."""
    return gaps.where("length > 0").select(
        F.col("sequence_id").alias("row"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("piece", "int"), ("start", "long"))),
        "length",
        F.lit(None).cast("long").alias("ids_crc32"),
        F.lit(True).alias("gap"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 4096,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens by best fit.

    A null text is empty, that is one token (id 1). Returns doc_id, piece, start, length,
    ids_crc32, sequence_id, offset, one row per piece. Repeated rows are packed each on their
    own. Other columns of the input do not matter; an empty table gives no rows.

    Bulk-synchronous best fit. Pieces of more than half of a sequence begin one each, and as many
    empty sequences are opened as the rest needs in any case. In every superstep pieces and gaps
    are range-sorted together by size; each range sweeps down and gives each piece its successor,
    the smallest gap that holds it; pieces that wait and gaps that are left are matched between
    ranges by their ranks, for which the driver has one row per range; the gaps shrink, and the next
    superstep takes what waits. A piece that no gap holds lets new sequences be opened. When
    ``range_rows`` rows are left, one task places them. What is counted on the driver does not
    grow with the pieces; the rows of a superstep are its pieces, and gaps that can still take one.
    """
    spark = docs.sparkSession
    cut = written(
        pieces(docs, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces"
    )
    small = F.col("length") * 2 <= capacity
    own = cut.where(~small).withColumn("sequence_id", F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    done = [own.select(*_OUT)]
    left = cut.where(small).select(
        "row", "doc_id", "piece", "start", "length", "ids_crc32", F.lit(False).alias("gap")
    )
    left = left.unionByName(_gap_rows(own.select("sequence_id", (capacity - F.col("length")).alias("length"))))
    new = -1
    while True:
        is_piece, size = ~F.col("gap"), F.col("length")
        n, most, least, need, room, widest = left.agg(
            F.count(F.when(is_piece, 1)), F.max(F.when(is_piece, size)), F.min(F.when(is_piece, size)),
            F.sum(F.when(is_piece, size)), F.sum(F.when(F.col("gap"), size)), F.max(F.when(F.col("gap"), size)),
        ).first()
        if not n:
            break
        # gaps that no piece fits into are of no use any more
        left = left.where(is_piece | (size >= least))
        n_rows = left.count()
        if n_rows <= range_rows:
            rest = written(sweep(left, capacity, 1, new), "packing-rest")
            done.append(rest.where(F.col("state") == PLACED).select(*_OUT))
            break
        opened = max(0, (need - (room or 0)) // capacity)
        if not opened and most > (widest or 0):
            unfit = left.where(is_piece & (size > (widest or 0))).agg(F.sum("length")).first()[0]
            opened = -(-unfit // capacity)
        if opened:
            fresh = spark.range(opened).select(
                (new - F.col("id")).alias("sequence_id"), F.lit(capacity).cast("long").alias("length")
            )
            left, new = left.unionByName(_gap_rows(fresh)), new - opened
        tasks = min(shuffle_tasks(spark), -(-(n_rows + opened) // range_rows))
        placed, left = _superstep(left, capacity, tasks)
        done += placed
    return reduce(DataFrame.unionByName, done)
