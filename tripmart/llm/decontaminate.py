"""Operator 1: documents that hold benchmark passages, found by latent semantic retrieval."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, chunks, doubling_sum, keyed, written
from tripmart.llm.ngrams import code_points, word_hashes

# Words of a block; a passage is two blocks, and the next one begins a block later.
BLOCK = 16

# Hashed terms of TF-IDF vectors, and dimensions of the latent space.
LOG2_TERMS = 14
TERMS = 1 << LOG2_TERMS
RANK = 64

# Words whose passages a task works on at once.
CHUNK_WORDS = 250_000

# A passage is a candidate for a passage of an item from this share of what that has in the latent
# space, if the TF-IDF vectors themselves are that near, too. Passages begin every 16 words on both
# sides, so 13 words that stand in both lie in one pair of passages, and are 0.4 of it.
LEAST_COSINE = 0.28
LEAST_TFIDF = 0.28

# An item counts as found if so many of its words in a row stand in the document, and are no
# boilerplate: their mean inverse document frequency tells.
RUN = 13
RUN_IDF = 1.0

# Or if so much of it stands there in the same order: nearly all of it on its own, or less together
# with its answer. Shares are of words and of TF-IDF weight; beyond LONG words, of words only.
WHOLE = 0.75
PARAPHRASE = 0.5
ANSWER = 0.75
ANSWER_WORDS = 8
LONG = 2_000

# Item passages that every task holds at a time; more are searched for in further passes.
PROBES = 50_000

_IDS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("words", pa.binary())])
_V = pa.schema([("v", pa.binary())])
_HITS = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
     ("cosine", pa.float64()), ("lcs", pa.float64()), ("run", pa.int64()), ("answer", pa.bool_())]
)
_SENTENCE = re.compile(r"[.!?]+\s+(?=\S)")


def _alnum(points: np.ndarray) -> np.ndarray:
    return _ALNUM[np.minimum(points, len(_ALNUM) - 1)]


_ALNUM = np.array([chr(i).isalnum() for i in range(0x3000)] + [True], bool)


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words (letters and digits, lower case), and counts per text."""
    points, starts = code_points([t.lower() for t in texts])
    values, first = word_hashes(np.where(_alnum(points), points, 32))
    counts = np.diff(np.searchsorted(first, starts))
    return (values >> np.uint64(32)).astype(np.uint32), counts


def term_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint32(32 - LOG2_TERMS)).astype(np.int32)


def word_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the hashed words of every document, written."""

    def take(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                values, counts = hashed([t or "" for t in chunk.column(1).to_pylist()])
                ends = np.cumsum(counts)
                own = [values[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)]
                yield arrays(_IDS, chunk.column(0), chunk.column(2), own)

    return written(keyed(docs).mapInArrow(take, "doc_id long, text_key long, words binary"), "hashed-words")


def _groups(batches, column: int):
    """Rows of about ``CHUNK_WORDS`` words: a slice of the batch, its words, counts per row."""
    for batch in batches:
        blobs = batch.column(column).to_pylist()
        sizes = np.array([len(b) // 4 for b in blobs])
        for a, b in chunks(sizes, CHUNK_WORDS):
            words = np.frombuffer(b"".join(blobs[a:b]), np.uint32)
            yield batch.slice(a, b - a), words, sizes[a:b]


def _blocks(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Distinct terms of each block of ``size`` words, filled up with ``TERMS``; its first word; its row."""
    n = -(-counts // size)
    row = np.repeat(np.arange(len(counts)), n)
    number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    own = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    terms = np.full(len(row) * size, TERMS, np.int32)
    terms[np.repeat((np.cumsum(n) - n) * size, counts) + own] = term_of(words)
    # a term counts once in a block
    terms = np.sort(terms.reshape(-1, size), 1)
    terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = TERMS
    return terms, np.repeat(np.cumsum(counts) - counts, n) + number * size, row


def _sums(terms: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows of each block's terms."""
    total = table[terms[:, 0]]
    for column in terms.T[1:]:
        total += table[column]
    return total


def _filled(table: np.ndarray) -> np.ndarray:
    """A table of terms with nothing for the place that fills blocks up."""
    return np.concatenate((table, np.zeros((1, *table.shape[1:]), table.dtype))).astype(np.float32)


class Items:
    """Benchmark items: their words and where the answer is, and the passages they are cut into."""

    def __init__(self):
        self.ids, self.words, self.answers = [], [], []
        self.passages: list[np.ndarray] = []
        self.item: list[int] = []
        self.offset: list[int] = []

    def add(self, item: int, text: str) -> None:
        words = hashed([text])[0]
        if not len(words):
            return
        last = hashed([_SENTENCE.split(text.strip())[-1]])[0]
        answer = words[-min(len(last), ANSWER_WORDS) :] if len(last) else words[-ANSWER_WORDS:]
        for at in range(0, max(1, len(words) - BLOCK), BLOCK):
            self.passages.append(np.unique(term_of(words[at : at + 2 * BLOCK])))
            self.item.append(len(self.ids))
            self.offset.append(at)
        self.ids.append(item)
        self.words.append(words)
        self.answers.append(answer)


def passage_frequencies(words: DataFrame) -> tuple[np.ndarray, float]:
    """Of each term the passages that hold it, and the number of passages, over all documents."""

    def count(batches):
        total = np.zeros(TERMS + 1)
        for _, own, counts in _groups(batches, 0):
            terms = _blocks(own, counts, 2 * BLOCK)[0]
            total[:-1] += np.bincount(terms.ravel(), minlength=TERMS + 1)[:TERMS]
            total[-1] += len(terms)
        yield arrays(_V, [total.tobytes()])

    found = doubling_sum(words.select("words").mapInArrow(count, "v binary"), TERMS + 1, "f8")
    return found[:-1], float(found[-1])


def latent_space(words: DataFrame, items: DataFrame, idf: np.ndarray, n_passages: float) -> np.ndarray:
    """Right singular vectors (TERMS x RANK) of all passages and the items', by random projection.

    The matrix has a row of length 1 for each passage of two blocks of the documents and of the
    items (both tables of words), the latter weighted to count as much as the former. One
    distributed pass sums what the passages give to the sketch A'(A R), another one A Q's products;
    between them only matrices of the sketch's size are on the driver.
    """
    spark = words.sparkSession
    rank = min(RANK, TERMS)
    projection = np.random.default_rng(23).standard_normal((TERMS, rank)).astype(np.float32)
    squares = _filled(idf**2)

    def projected(own, counts, table):
        terms = _blocks(own, counts, 2 * BLOCK)[0]
        scale = 1 / np.sqrt(np.maximum(_sums(terms, squares), 1e-9))
        return terms, _sums(terms, table) * scale[:, None], scale

    weighted = spark.sparkContext.broadcast(_filled(idf[:, None] * projection))

    def sketch(batches):
        total = np.zeros((rank, TERMS + 1))
        for _, own, counts in _groups(batches, 0):
            terms, rows, scale = projected(own, counts, weighted.value)
            flat, block = terms.ravel(), np.repeat(np.arange(len(terms)), terms.shape[1])
            for into, given in zip(total, (rows * scale[:, None]).T.astype(np.float64), strict=True):
                into += np.bincount(flat, given[block], TERMS + 1)
        yield arrays(_V, [total[:, :TERMS].T.astype(np.float32).tobytes()])

    def summed(table: DataFrame, of, size: int, dtype: str) -> np.ndarray:
        return doubling_sum(table.select("words").mapInArrow(of, "v binary"), size, dtype)

    share = n_passages / max(passage_frequencies(items)[1], 1.0)
    sketched = summed(words, sketch, TERMS * rank, "f4") + share * summed(items, sketch, TERMS * rank, "f4")
    sketched = idf[:, None] * sketched.reshape(TERMS, rank)
    basis = np.linalg.qr(sketched.astype(np.float64))[0].astype(np.float32)
    based = spark.sparkContext.broadcast(_filled(idf[:, None] * basis))

    def product(batches):
        total = np.zeros((rank, rank))
        for _, own, counts in _groups(batches, 0):
            rows = projected(own, counts, based.value)[1]
            total += rows.T @ rows
        yield arrays(_V, [total.tobytes()])

    gram = summed(words, product, rank * rank, "f8") + share * summed(items, product, rank * rank, "f8")
    values, turn = np.linalg.eigh(gram.reshape(rank, rank))
    return basis @ turn[:, np.argsort(-values)].astype(np.float32)


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel steps over the text."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    whole = (1 << len(item)) - 1
    state = whole
    for w in text.tolist():
        if w in masks:
            met = state & masks[w]
            state = ((state + met) | (state - met)) & whole
    return len(item) - state.bit_count()


def weighted_subsequence(item: np.ndarray, text: np.ndarray, weights: np.ndarray) -> float:
    """Largest weight of a common subsequence, as a share of the item's weight."""
    best = np.zeros(len(item) + 1)
    for w in text[np.isin(text, item)].tolist():
        added = best[:-1] + np.where(item == w, weights, 0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], added))
    return float(best[-1] / max(weights.sum(), 1e-9))


def longest_run(item: np.ndarray, text: np.ndarray, least: int) -> tuple[int, int]:
    """Length and first word (in the item) of the longest common run of ``least`` words or more."""
    if len(item) < least or len(text) < least:
        return 0, 0
    powers = np.multiply.accumulate(np.full(least, 0x9E3779B97F4A7C15, np.uint64))

    def grams(words: np.ndarray) -> np.ndarray:
        wide = words.astype(np.uint64) + np.uint64(1)
        total = wide[: len(wide) - least + 1] * powers[0]
        for i in range(1, least):
            total += wide[i : len(wide) - least + 1 + i] * powers[i]
        return total

    own, order = np.unique(grams(item), return_index=True)
    theirs = grams(text)
    at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    best = (0, 0)
    for j in np.flatnonzero(own[at] == theirs).tolist():
        i = int(order[at[j]])
        if best[0] and j + best[0] <= len(text) and i + best[0] <= len(item):
            # a run that began earlier holds this one, or this one has to be longer
            if not np.array_equal(item[i : i + best[0]], text[j : j + best[0]]):
                continue
        n = min(len(item) - i, len(text) - j)
        differs = np.flatnonzero(item[i : i + n] != text[j : j + n])
        n = int(differs[0]) if len(differs) else n
        if n >= least and n > best[0]:
            best = (n, i)
    return best


class Finder:
    """Passages of benchmark items in the latent space, and the checks on candidates."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray):
        self.items, self.idf = items, idf
        self.table = _filled(idf[:, None] * space)
        self.squares = _filled(idf**2)
        # terms of each item passage, filled up, and their weights in a vector of length 1
        self.terms = np.full((len(items.passages), 2 * BLOCK), TERMS, np.int32)
        for row, terms in zip(self.terms, items.passages, strict=True):
            row[: len(terms)] = terms
        weights = np.append(idf, 0).astype(np.float32)[self.terms]
        self.weights = weights / np.maximum(np.sqrt((weights**2).sum(1, keepdims=True)), 1e-9)
        own = np.einsum("ij,ijk->ik", self.weights, np.append(space, np.zeros((1, space.shape[1])), 0)[self.terms])
        # a passage's product with this is its share of what the item's has in the space
        self.probes = (own / np.maximum((own**2).sum(1, keepdims=True), 1e-9)).T.astype(np.float32)
        self.item, self.offset = np.array(items.item), np.array(items.offset)

    def candidates(self, words: np.ndarray, counts: np.ndarray):
        """Rows, first words, item passages near to a passage, with the share."""
        terms, starts, row = _blocks(words, counts, BLOCK)
        if not len(starts):
            return [], [], [], []
        sums, length = _sums(terms, self.table), _sums(terms, self.squares)
        pair = np.flatnonzero(np.append(row[1:] == row[:-1], False))
        sums[pair] += sums[pair + 1]
        length[pair] += length[pair + 1]
        scale = 1 / np.sqrt(np.maximum(length, 1e-9))
        sums *= scale[:, None]
        paired = np.zeros(len(terms), bool)
        paired[pair] = True
        found = []
        step = max(1, 4_000_000 // self.probes.shape[1])
        for a in range(0, len(starts), step):
            near = sums[a : a + step] @ self.probes
            at, probe = np.divmod(np.flatnonzero(near >= LEAST_COSINE), near.shape[1])
            near, at = near[at, probe], at + a
            exact = self._weight(terms, paired, at, probe)
            keep = np.flatnonzero(exact * scale[at] >= LEAST_TFIDF)
            found.append((at[keep], probe[keep], near[keep]))
        at, probe, near = (np.concatenate(x) for x in zip(*found, strict=True))
        return row[at], starts[at], probe, near

    def _weight(self, terms: np.ndarray, paired: np.ndarray, at: np.ndarray, probe: np.ndarray) -> np.ndarray:
        """Product of document and item passages, of their TF-IDF vectors."""
        total = np.zeros(len(at), np.float32)
        weights = np.append(self.idf, 0).astype(np.float32)
        for a in range(0, len(at), 4096):
            some, own = at[a : a + 4096], self.terms[probe[a : a + 4096]]
            given = self.weights[probe[a : a + 4096]] * weights[own]
            hit = (own[:, :, None] == terms[some][:, None, :]).any(2)
            second = np.flatnonzero(paired[some])
            hit[second] |= (own[second][:, :, None] == terms[some[second] + 1][:, None, :]).any(2)
            total[a : a + 4096] = (given * hit).sum(1)
        return total

    def check(self, text: np.ndarray, item: int, start: int, offset: int) -> tuple[float, int, bool] | None:
        """Share of the item in order around a passage, longest run, and the answer, if found.

        ``offset`` is where in the item its passage begins: the item is looked for around there.
        """
        words = self.items.words[item]
        slack = 2 * BLOCK + len(words) // 4
        region = text[max(0, start - offset - slack) : start - offset + len(words) + slack]
        run, first = longest_run(words, region, RUN)
        if run and self.idf[term_of(words[first : first + run])].mean() < RUN_IDF:
            run = 0
        share = common_subsequence(words, region) / len(words)
        there = False
        if share >= PARAPHRASE:
            weight = share
            if len(words) <= LONG:
                weight = weighted_subsequence(words, region, self.idf[term_of(words)])
            answer = self.items.answers[item]
            there = common_subsequence(answer, region) >= ANSWER * len(answer)
            if min(share, weight) >= WHOLE or (min(share, weight) >= PARAPHRASE and there):
                return share, run, there
        return (share, run, there) if run else None

    def leaks(self, text: np.ndarray, hits: list[tuple[int, int, float]]) -> dict[int, tuple]:
        """The best of a document's candidates (first word, item passage, share) for each item found."""
        best: dict[int, tuple] = {}
        seen: set[tuple[int, int]] = set()
        for start, probe, near in sorted(hits, key=lambda h: -h[2]):
            item, offset = int(self.item[probe]), int(self.offset[probe])
            # candidates that place the item alike are one
            place = (item, (start - offset) // (2 * BLOCK))
            if place in seen:
                continue
            seen.add(place)
            met = self.check(text, item, start, offset)
            if met:
                entry = (-met[0], -met[1], start, near, met[2])
                best[item] = min(best.get(item, entry), entry)
        return best


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items found in documents: doc_id, text_key, item_id, start, cosine, lcs, run, answer.

    One row for each row of the documents and item found in it: the best of its passages, by the
    share ``lcs`` of the item's words that stand there in the same order, by the longest run of them
    (``run``, 0 below 13 words), then by place. ``start`` is the passage's first word. Null and
    empty texts have no passage; items without a word or without an id are never found. Items that
    repeat an id are one each. Other columns do not matter.

    Documents and items are cut into passages of 32 words, a new one every 16: TF-IDF vectors of
    hashed terms, which span a latent space by a distributed randomised SVD. Where passages of both
    are near there, the item is checked word by word around: by its longest consecutive run, which
    tells excerpts of 13 words or more, and by the longest common subsequence, by number and by
    weight, alone if it is nearly all of the item, else together with the item's answer (its last
    sentence, eight words at most), which tells paraphrases. Items go to the tasks in blocks of
    ``PROBES`` passages, one pass over the documents each.
    """
    spark = docs.sparkSession
    rows = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")
    ).where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    rows = rows.distinct()
    words = word_table(docs)
    fields = "doc_id long, text_key long, item_id long, start long, cosine double, lcs double, run long, answer boolean"
    asked = word_table(rows.select(F.col("item_id").alias("doc_id"), "text"))
    df, n = passage_frequencies(words)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    space = latent_space(words, asked, idf, max(n, 1.0))
    found = [_search(words, items, idf, space, fields) for items in _item_blocks(rows)]
    if not found:
        return spark.createDataFrame([], fields)
    return reduce(DataFrame.union, found)


def _item_blocks(rows: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``PROBES`` passages; the driver holds one at a time."""
    items = Items()
    for row in rows.toLocalIterator():
        items.add(row.item_id, row.text)
        if len(items.passages) >= PROBES:
            yield items
            items = Items()
    if items.ids:
        yield items


def _search(words: DataFrame, items: Items, idf: np.ndarray, space: np.ndarray, fields: str) -> DataFrame:
    """Leaks of a block of items in all documents."""
    shared = words.sparkSession.sparkContext.broadcast(Finder(items, idf, space))

    def find(batches):
        finder = shared.value
        for part, own, counts in _groups(batches, 2):
            begin = np.cumsum(counts) - counts
            near: dict[int, list] = {}
            for r, start, probe, share in zip(*finder.candidates(own, counts), strict=True):
                near.setdefault(int(r), []).append((int(start - begin[r]), int(probe), float(share)))
            rows = []
            for r, hits in near.items():
                for item, entry in finder.leaks(own[begin[r] : begin[r] + counts[r]], hits).items():
                    share, run, start, cosine, there = entry
                    rows.append((r, finder.items.ids[item], start, cosine, -share, -run, there))
            if rows:
                at, item, start, cosine, share, run, there = zip(*rows, strict=True)
                at = pa.array(at)
                yield arrays(
                    _HITS, part.column(0).take(at), part.column(1).take(at), item, start, cosine, share, run, there
                )

    return words.mapInArrow(find, fields)
