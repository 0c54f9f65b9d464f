"""Operator 9: remove words of passages that occur earlier in the corpus."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import bloom
from tripmart.llm.common import arrays, batch_chunks, keyed, same_document, shuffle_tasks, text_bytes
from tripmart.llm.fmindex import FmIndex, earliest_occurrences

# Words of an n-gram whose smallest hash in a window says which shard the window belongs to.
GRAM = 5
# Words a shard would hold, were all windows suspects.
SHARD_WORDS = 4_000_000

# An n-gram whose windows have more words than this is split by the windows' own content.
HOT_WORDS = SHARD_WORDS // 4

# Bytes of a word's hash that are sent to a shard.
WORD_BYTES = 6

# Fixed value: what a null doc_id is ordered as.
FIRST = np.iinfo(np.int64).min

_FOUND = pa.schema(
    [("shard", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()),
     ("windows", pa.int32()), ("words", pa.binary())]
)
_FIELDS = "shard int, doc_id long, text_key long, start long, windows int, words binary"
_SPAN = pa.schema(list(_FOUND)[1:5])

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _spread(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers out of any."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _multipliers(n: int) -> np.ndarray:
    """The first ``n`` of a fixed row of random odd numbers."""
    return _spread(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _run_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of values that lie one behind the other."""
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    mixed = values * _multipliers(int(lengths.max()))[place]
    return _spread(np.add.reduceat(mixed, starts) + lengths.astype(np.uint64))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and how many words each text has."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    blank = _BLANK[data]
    ends = np.flatnonzero(blank & ~np.concatenate(([True], blank[:-1])))
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds, "left"), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    letters = data[~blank].astype(np.uint64) + np.uint64(1)
    return _run_hashes(letters, np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths), counts


def segments(words: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows whose leftmost smallest n-gram is the same one.

    Returns for each run its first window's place among all words, its number of windows, and
    the hash of the n-gram. Equal windows have equal n-gram hashes, wherever they stand.
    """
    n, grams = len(words) - window + 1, window - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = words[: len(words) - GRAM + 1].copy()
    for i, m in enumerate(_multipliers(GRAM)):
        hashes += words[i : i + len(hashes)] * m
    hashes = _spread(hashes)
    # the place, which tells equal n-grams apart, in the low bits
    low = np.uint64(26)
    least = (hashes >> low << low) | np.arange(len(hashes), dtype=np.uint64)
    covered = 1
    while covered < grams:
        step = min(covered, grams - covered)
        least = np.minimum(least[: len(least) - step], least[step:])
        covered += step
    place = (least & np.uint64((1 << 26) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = doc[:n] == doc[window - 1 :]
    new = whole & np.concatenate(([True], (place[1:] != place[:-1]) | ~whole[:-1]))
    first = np.flatnonzero(new)
    sizes = np.add.reduceat(whole.astype(np.int64), first) if len(first) else first
    return first, sizes, hashes[place[first]]


def _gather(first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of runs, and where each run begins among them."""
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.repeat(first - begin, lengths) + np.arange(int(lengths.sum())), begin


def _first_of_equal(content: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal content: the first in order; and which rows come after it."""
    by = np.lexsort((*reversed(order), content))
    new = np.concatenate(([True], content[by][1:] != content[by][:-1]))
    head = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(by), bool)
    for column in order:
        later |= column[by] != column[head]
    first, after = np.zeros(len(by), bool), np.zeros(len(by), bool)
    first[by], after[by] = new, later
    return first, after


def _spans(doc_id, text_key, start, windows) -> tuple[np.ndarray, ...]:
    """Spans of windows in one, where they follow each other in a document."""
    by = np.lexsort((start, text_key, doc_id))
    doc_id, text_key, start, windows = (x[by] for x in (doc_id, text_key, start, windows))
    new = np.ones(len(by), bool)
    new[1:] = (
        (doc_id[1:] != doc_id[:-1]) | (text_key[1:] != text_key[:-1]) | (start[1:] != start[:-1] + windows[:-1])
    )
    at = np.flatnonzero(new)
    return doc_id[at], text_key[at], start[at], np.add.reduceat(windows, at) if len(at) else windows


def _decided(doc_id, text_key, start, windows, shards: int) -> pa.RecordBatch:
    """Rows without words, over all shards: spans known to occur earlier."""
    doc_id, text_key, start, windows = _spans(doc_id, text_key, start, windows)
    return arrays(
        _FOUND, (text_key % shards).astype(np.int32), doc_id, text_key, start, windows.astype(np.int32),
        pa.nulls(len(doc_id), pa.binary()),
    )


def _packed(words: np.ndarray) -> bytes:
    return words.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    own = np.frombuffer(data, np.uint8).reshape(-1, WORD_BYTES)
    whole = np.zeros((len(own), 8), np.uint8)
    whole[:, :WORD_BYTES] = own
    return whole.reshape(-1).view(np.uint64)


def hot_grams(rows: DataFrame, repeats, window: int) -> np.ndarray:
    """Hashes, in order, of n-grams whose suspected windows hold more than ``HOT_WORDS`` words.

    There is at most one for so many words of the corpus.
    """
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def count(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                _, sizes, grams = segments(*hashed_words(text_bytes(chunk.column(0))), window)
                at = np.flatnonzero(bloom.suspects(repeats.value, grams))
                held, of = np.unique(grams[at], return_inverse=True)
                yield arrays(schema, held.view(np.int64), np.bincount(of, sizes[at] + window - 1, len(held)).astype(np.int64))

    counted = rows.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") > HOT_WORDS).select("gram").collect()
    return np.sort(np.array([r.gram for r in found], np.int64).view(np.uint64))


def suspected_windows(docs: DataFrame, window: int) -> tuple[DataFrame, int]:
    """Runs of windows to compare, with the shard that compares them; and the number of shards."""
    rows = keyed(docs)

    def insert(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                yield bloom.inserts(segments(*hashed_words(text_bytes(chunk.column(0))), window)[2])

    repeats, total = bloom.repeats(rows.select("text").mapInArrow(insert, bloom.INSERTS), "gram-inserts")
    shards = max(1, -(-total * (window + 8) // SHARD_WORDS))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(repeats)
    hot = context.broadcast(hot_grams(rows, shared, window))

    def find(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                words, counts = hashed_words(text_bytes(chunk.column(1)))
                first, sizes, grams = segments(words, counts, window)
                at = np.flatnonzero(bloom.suspects(shared.value, grams))
                if not len(at):
                    continue
                first, sizes, grams = first[at], sizes[at], grams[at]
                # windows of a hot n-gram go one by one, each by what it says
                split = np.isin(grams, hot.value)
                single, _ = _gather(first[split], sizes[split]) if split.any() else (first[:0], None)
                first, grams = np.concatenate((first[~split], single)), grams[~split]
                sizes = np.concatenate((sizes[~split], np.ones(len(single), np.int64)))
                lengths = sizes + window - 1
                places, begin = _gather(first, lengths)
                content = _run_hashes(words[places], begin, lengths)
                meets = np.concatenate((grams, content[len(grams) :]))
                doc_at = np.cumsum(counts) - counts
                doc = np.searchsorted(doc_at, first, "right") - 1
                ids = chunk.column(0).fill_null(FIRST).to_numpy()[doc]
                keys = chunk.column(2).to_numpy()[doc]
                start = first - doc_at[doc]
                # copies within the chunk are decided here: only the first is sent on
                lead, after = _first_of_equal(content, ids, keys, start)
                if after.any():
                    yield _decided(ids[after], keys[after], start[after], sizes[after], shards)
                own = np.flatnonzero(lead)
                yield arrays(
                    _FOUND, (meets[own] % np.uint64(shards)).astype(np.int32), ids[own], keys[own], start[own],
                    sizes[own].astype(np.int32), [_packed(words[a : a + n]) for a, n in zip(first[own], lengths[own], strict=True)],
                )

    return rows.select("doc_id", "text", "text_key").mapInArrow(find, _FIELDS), shards


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """Windows that occur earlier: doc_id (null as ``FIRST``), text_key, start, windows.

    Each row is a span: ``windows`` windows that begin at word ``start`` and the words after it.
    """
    sent, shards = suspected_windows(docs, window)

    def by_shard(batches):
        held, shard = [], None
        for batch in batches:
            of = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(of)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True):
                if a == b:
                    continue
                if of[a] != shard:
                    yield from _match(held, window)
                    held, shard = [], of[a]
                held.append(batch.slice(a, b - a))
        yield from _match(held, window)

    return (
        sent.repartition(max(shards, shuffle_tasks(docs.sparkSession)), "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(by_shard, "doc_id long, text_key long, start long, windows int")
    )


def _match(held: list[pa.RecordBatch], window: int):
    """Spans of a shard's windows that occur earlier in the shard, by its index."""
    if not held:
        return
    table = pa.Table.from_batches(held)
    known = table.filter(pc.is_null(table.column(5)))
    if known.num_rows:
        yield from known.select([1, 2, 3, 4]).to_batches()
    table = table.filter(pc.is_valid(table.column(5)))
    if not table.num_rows:
        return
    ids, keys, start, sizes = (table.column(i).to_numpy() for i in (1, 2, 3, 4))
    words = _unpacked(b"".join(table.column(5).to_pylist()))
    lengths = sizes.astype(np.int64) + window - 1
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    lead, after = _first_of_equal(_run_hashes(words, begin, lengths), ids, keys, start)
    spans = [(ids[after], keys[after], start[after], sizes[after].astype(np.int64))]

    # the index holds each distinct run once, in the order of documents, after a separator
    own = np.flatnonzero(lead)
    own = own[np.lexsort((start[own], keys[own], ids[own]))]
    places, _ = _gather(begin[own], lengths[own])
    runs = lengths[own]
    at = np.cumsum(runs + 1) - runs
    text = np.zeros(int((runs + 1).sum()), np.int64)
    text[_gather(at, runs)[0]] = np.unique(words[places], return_inverse=True)[1] + 1
    index = FmIndex(text, window)
    for piece, offset, earliest in earliest_occurrences(index, text, at, runs):
        hit = np.flatnonzero(earliest < at[piece] + offset)
        row = own[piece[hit]]
        spans.append((ids[row], keys[row], start[row] + offset[hit], np.ones(len(hit), np.int64)))
    merged = _spans(*(np.concatenate(x) for x in zip(*spans, strict=True)))
    if len(merged[0]):
        yield arrays(_SPAN, *merged[:3], merged[3].astype(np.int32))


def remove_repeats(docs: DataFrame, window: int = 20, texts: bool = True) -> DataFrame:
    """Remove every word that a window of ``window`` words covers which also occurs earlier.

    Words are separated by ASCII white space and compared as they are; a null text has none.
    Earlier: in a document with a smaller ``doc_id`` (null first; rows with one ``doc_id`` and
    different texts are ordered by the texts' hashes), or in the same document at an earlier
    start. Windows are judged on the input. Returns doc_id, text_key, n_words, n_removed,
    kept_sha256 and, with ``texts``, kept (words joined by one space), a row per input row; rows
    that repeat a document have equal results. Other columns do not matter.

    Every window belongs to the shard of its smallest n-gram, so equal windows meet in one
    shard; windows of an n-gram that is hot (a short phrase with ever other words around it) are dealt
    by their own content. Two Bloom filters leave out windows whose n-gram was seen once. Of equal runs of
    windows a task sends only its first to the shard. A shard builds an FM-index of its distinct
    runs and streams them through it by backward search; what it reports are the windows whose
    earliest occurrence lies before. Words are compared by 48-bit hashes.
    """
    rows = keyed(docs)
    spans = (
        repeated_windows(docs, window)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))
        .withColumn("doc_id", F.when(F.col("doc_id") != int(FIRST), F.col("doc_id")))
    )
    joined = rows.join(spans, same_document(rows, spans), "left").select(
        rows["doc_id"], rows["text_key"], rows["text"], "starts", "windows"
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("kept_sha256", pa.string())] + [("kept", pa.string())] * texts
    )

    def cut(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                out = []
                for text, starts, sizes in zip(
                    text_bytes(chunk.column(2)), chunk.column(3).to_pylist(), chunk.column(4).to_pylist(), strict=True
                ):
                    words = text.split()
                    kept = words
                    if starts:
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, starts, 1)
                        np.add.at(change, np.array(starts) + sizes + window - 1, -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                    whole = b" ".join(kept)
                    out.append((len(words), len(words) - len(kept), hashlib.sha256(whole).hexdigest(), whole))
                columns = list(zip(*out, strict=True))
                more = [pa.array(columns[3], pa.binary()).cast(pa.string())] * texts
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), chunk.column(1),
                     *(pa.array(c, f.type) for c, f in zip(columns[:3], list(schema)[2:5], strict=True)), *more],
                    schema=schema,
                )

    fields = "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string"
    return joined.mapInArrow(cut, fields + ", kept string" * texts)
