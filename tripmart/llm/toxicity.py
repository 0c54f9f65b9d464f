"""Operator 10: toxicity by votes of the nearest labelled examples."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, chunks, doubling_sum, keyed, written
from tripmart.llm.ngrams import SPACE, code_points, gram_hashes, letters_only, word_hashes
from tripmart.llm.samples import held_out, labelled_sample

# Bound of the fit: labelled examples of each class.
PER_CLASS = 1_500

# Terms are all words and the beginnings of longer ones, hashed to so many bits.
LOG2_TERMS = 18
TERMS = 1 << LOG2_TERMS
STEM = 5

# Every term weighs by its inverse document frequency times a factor between the floor and 1: how
# surely, among the examples, it goes with the label (its log-likelihood ratio, where the bar is
# what chance among that many terms gives). So topics decide only between texts that agree in what
# speaks for the label.
FLOOR = 0.02
SURE = 50.0

# Votes fall with the cube of the distance from a point just beside the text. The average of all
# examples has as many votes as so many examples at distance 1, so that a few far ones do not decide.
NEIGHBOURS = 24
BESIDE = 0.05
AVERAGE_VOTES = 15

BLOCK = 256

# A term in this share of the examples is common; texts are scored so many at a time.
COMMON = 0.06
BATCH = 256

# Letters of texts that are cut into terms at once.
PART_BYTES = 250_000

_LETTERS = re.compile(r"[^\W\d_]+")


def _signature(text: str) -> int:
    """Equal for nearly all near copies: the two smallest hashes of a text's long words."""
    words = {w for w in _LETTERS.findall(text.lower()) if len(w) > 7}
    least = heapq.nsmallest(2, (xxhash.xxh64_intdigest(w) for w in words))
    return xxhash.xxh64_intdigest(repr(least) if least else text) >> 1


def without_copies(sample: DataFrame) -> DataFrame:
    """A sample with one row of each group of near copies: words of a copied text are no signs."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("signature", pa.int64())])

    def sign(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                signed = [_signature(t or "") for t in chunk.column(2).to_pylist()]
                yield arrays(schema, chunk.column(0), chunk.column(1), signed)

    # as bounded as the sample
    signed = sample.mapInArrow(sign, "doc_id long, label int, signature long")
    first = signed.groupBy("label", "signature").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return sample.join(F.broadcast(first.distinct()), "doc_id", "left_semi")


def term_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text, the terms in it and how often: (bounds of the texts, terms, counts).

    Terms are hashed: the runs of letters, lower-cased, and the first STEM letters of longer ones.
    """
    points, starts = letters_only(*code_points([t.lower() for t in texts]))
    words, first = word_hashes(points)
    owner = np.searchsorted(starts, first, "right") - 1
    # a text ends in a space, so the places behind a word's first letter are there or in the next text
    places = np.minimum(first[:, None] + np.arange(STEM + 1), len(points) - 1)
    begin = first[(points[places] != SPACE).all(1)]
    stems = gram_hashes(points, STEM)[begin] if len(begin) else words[:0]
    owner = np.concatenate((owner, np.searchsorted(starts, begin, "right") - 1))
    terms = (np.concatenate((words, stems)) >> np.uint64(64 - LOG2_TERMS)).astype(np.int64)
    cells, counts = np.unique((owner << LOG2_TERMS) | terms, return_counts=True)
    bounds = np.searchsorted(cells, np.arange(len(texts) + 1) << LOG2_TERMS)
    return bounds, cells & (TERMS - 1), counts


def in_parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts of about ``PART_BYTES`` together; their arrays take some fifty times that."""
    for a, b in chunks(np.array([len(t) for t in texts]), PART_BYTES):
        yield texts[a:b]


def chunk_terms(chunk: pa.RecordBatch):
    """(terms, counts) of each text in column ``text``."""
    texts = [t or "" for t in chunk.column(chunk.schema.get_field_index("text")).to_pylist()]
    for part in in_parts(texts):
        bounds, terms, counts = term_counts(part)
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield terms[a:b], counts[a:b]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, float]:
    """In how many rows each term stands, and the number of rows: sums of one vector per task."""

    def count(batches):
        total = np.zeros(TERMS + 1, np.uint64)
        for batch in batches:
            for chunk in batch_chunks(batch):
                total[-1] += np.uint64(chunk.num_rows)
                for part in in_parts([t or "" for t in chunk.column(0).to_pylist()]):
                    _, terms, _ = term_counts(part)
                    np.add.at(total, terms, np.uint64(1))
        yield arrays(pa.schema([("v", pa.binary())]), [total.tobytes()])

    total = doubling_sum(texts.select("text").mapInArrow(count, "v binary"), TERMS + 1, "u8").astype(np.float64)
    return total[:-1], float(total[-1])


def association(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Log-likelihood ratio of each term and the label; 0 for a term that speaks against it.

    ``pos`` and ``neg`` count the examples of both kinds that hold the term.
    """
    n, both = n_pos + n_neg, pos + neg

    def part(seen, expected):
        some = (seen > 0) & (expected > 0)
        return np.where(some, seen * np.log(np.where(some, seen / np.where(expected > 0, expected, 1), 1)), 0)

    ratio = 2 * (
        part(pos, both * n_pos / n) + part(neg, both * n_neg / n)
        + part(n_pos - pos, (n - both) * n_pos / n) + part(n_neg - neg, (n - both) * n_neg / n)
    )
    return np.where(pos * n_neg > neg * n_pos, ratio, 0)


class BlockMaxIndex:
    """Postings of unit vectors, cut into blocks of examples, with block maxima per term."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        self.blocks = blocks = max(1, -(-self.n // BLOCK))
        example = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors])
        # only terms of examples have postings
        self.place_of = np.full(n_terms, -1, np.int32)
        held = np.unique(term)
        self.place_of[held] = np.arange(len(held))
        cell = self.place_of[term].astype(np.int64) * blocks + example // BLOCK
        order = np.argsort(cell, kind="stable")
        self.example = example[order].astype(np.int32)
        self.weights = weight[order].astype(np.float32)
        #: of each term and block, where its postings begin
        self.starts = np.searchsorted(cell[order], np.arange(len(held) * blocks + 1)).astype(np.int64)
        self.largest = np.zeros(len(held) * blocks, np.float32)
        np.maximum.at(self.largest, cell, weight)
        self.largest = self.largest.reshape(len(held), blocks)
        # terms in many examples: a matrix, which a batch of texts is multiplied with
        per_term = np.bincount(self.place_of[term], minlength=len(held))
        self.common = np.flatnonzero(per_term >= max(COMMON * self.n, 1))
        self.common_at = np.full(len(held), -1, np.int32)
        self.common_at[self.common] = np.arange(len(self.common))
        self.matrix = np.zeros((len(self.common), self.n), np.float32)
        at = self.common_at[self.place_of[term]]
        self.matrix[at[at >= 0], example[at >= 0]] = weight[at >= 0]

    def common_parts(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What common terms add to the cosines of each text and all examples."""
        dense = np.zeros((len(vectors), len(self.common)), np.float32)
        for row, (terms, weights) in zip(dense, vectors, strict=True):
            places = self.place_of[terms]
            at = self.common_at[places]
            here = (places >= 0) & (at >= 0)
            row[at[here]] = weights[here]
        return dense @ self.matrix

    def _add(self, scores: np.ndarray, places: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> None:
        """Add the products of a text's terms and the postings in some blocks to the scores."""
        cells = (places[:, None] * self.blocks + blocks[None, :]).ravel()
        first, size = self.starts[cells], self.starts[cells + 1] - self.starts[cells]
        some = size > 0
        first, size = first[some], size[some]
        if not len(size):
            return
        each = np.repeat(weights, len(blocks))[some]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
        products = np.repeat(each, size) * self.weights[at]
        scores += np.bincount(self.example[at], products, self.n)

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, common: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples with the largest cosine, exactly; ties go to the earlier example.

        The blocks with the largest bounds are scored first, then, with the k-th cosine of those as
        a bar, all others whose bound reaches it. ``common`` is the text's row of `common_parts`.
        """
        if common is None:
            common = self.common_parts([(terms, weights)])[0]
        places = self.place_of[terms]
        places, weights = places[places >= 0].astype(np.int64), weights[places >= 0]
        bounds = weights @ self.largest[places]
        rare = self.common_at[places] < 0
        places, weights = places[rare], weights[rare]
        order = np.argsort(-bounds, kind="stable")
        scores, done = common.astype(np.float64), 0
        while done < self.blocks:
            some = order[done : max(2, 4 * done)]
            if done and k <= self.n:
                reached = np.zeros(self.blocks, bool)
                reached[order[:done]] = True
                known = scores[np.repeat(reached, BLOCK)[: self.n]]
                if len(known) >= k:
                    bar = np.partition(known, len(known) - k)[len(known) - k] - 1e-6
                    some = some[bounds[some] >= bar]
                    if not len(some):
                        break
            self._add(scores, places, weights, some)
            done += len(some)
        seen = np.zeros(self.blocks, bool)
        seen[order[:done]] = True
        likely = np.flatnonzero(np.repeat(seen, BLOCK)[: self.n])
        cosines = scores[likely]
        if len(likely) > k:
            bar = np.partition(cosines, len(likely) - k)[len(likely) - k]
            some = cosines >= bar
            likely, cosines = likely[some], cosines[some]
        best = np.lexsort((likely, -cosines))[:k]
        return likely[best], cosines[best]


class Voters:
    """Labelled examples, and the votes of those nearest to a text's vector."""

    def __init__(self, examples: list[tuple], weight: np.ndarray, stand_for: dict[int, float]):
        self.weight = weight.astype(np.float32)
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.labels = np.array([e[1] for e in examples], np.float64)
        self.stand_for = np.array([stand_for[e[1]] for e in examples], np.float64)
        self.index = BlockMaxIndex([self.vector(e[2], e[3]) for e in examples], len(weight))
        self.share = float(self.stand_for @ self.labels / self.stand_for.sum())

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = (1 + np.log(counts)) * self.weight[terms]
        norm = np.sqrt((weights**2).sum())
        return terms, (weights / (norm or 1)).astype(np.float32)

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        found = []
        for a in range(0, len(texts), BATCH):
            vectors = [self.vector(*x) for x in texts[a : a + BATCH]]
            parts = self.index.common_parts(vectors)
            found += [self._vote(*x) for x in zip(vectors, parts, strict=True)]
        return found

    def _vote(self, vector: tuple[np.ndarray, np.ndarray], common: np.ndarray) -> tuple[float, list[int]]:
        if not len(vector[0]):
            return self.share, []
        ids, cosines = self.index.nearest(*vector, NEIGHBOURS, common)
        votes = self.stand_for[ids] / (BESIDE + np.maximum(0, 1 - cosines)) ** 3
        average = AVERAGE_VOTES * self.stand_for.mean()
        score = (votes @ self.labels[ids] + average * self.share) / (votes.sum() + average)
        return float(score), self.ids[ids[:3]].tolist()


def _voters(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> Voters | float:
    """Voters out of the labelled rows, or the label's share if there is nothing to vote with."""
    drawn, stand_for = labelled_sample(docs, labels, label, folds, fold, PER_CLASS)
    drawn = written(drawn, "toxic-drawn")
    sample = without_copies(drawn)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.binary()), ("counts", pa.binary())])

    def pack(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                found = [(t.astype("i4").tobytes(), c.astype("i4").tobytes()) for t, c in chunk_terms(chunk)]
                yield arrays(schema, chunk.column(0), chunk.column(1), *zip(*found, strict=True))

    packed = sample.select("doc_id", "label", "text").mapInArrow(pack, "doc_id long, label int, terms binary, counts binary")
    examples = [
        (r.doc_id, r.label, np.frombuffer(bytes(r.terms), np.int32), np.frombuffer(bytes(r.counts), np.int32))
        for r in packed.toLocalIterator()
    ]
    if not any(len(t) for _, _, t, _ in examples):
        return float(np.mean([e[1] for e in examples])) if examples else 0.0
    examples.sort(key=lambda e: (e[0], e[1]))
    # what was drawn stands for its class, also for the copies that went
    taken = {r.label: r.n for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    left = np.bincount([e[1] for e in examples], minlength=2)
    stand_for = {c: w * taken[c] / left[c] for c, w in stand_for.items() if left[c]}

    df, n = document_frequencies(keyed(docs))
    held = [np.zeros(TERMS), np.zeros(TERMS)]
    for _, c, terms, _ in examples:
        held[c][terms] += 1
    factor = np.clip(association(held[1], held[0], left[1], left[0]) / SURE, FLOOR, 1) if left.all() else np.ones(TERMS)
    return Voters(examples, factor * np.log(1 + n / np.maximum(df, 1)), stand_for)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0
) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted and evidence (ids of the three nearest examples).

    One row per input row. Texts without a word, null and empty ones too, get the label's share
    among labelled rows, and no evidence. Without any labelled row all scores are 0. Other columns
    of the inputs do not matter.

    Examples are a bounded sample of labelled rows outside the fold (``PER_CLASS`` of each class),
    both the label's and clean ones, without near copies of each other. Vectors are TF-IDF of all
    words (hashed, frequencies over all documents), weighted by how they go with the label, with
    length 1. For every text with a word, an inverted index in blocks with block maxima finds the
    nearest examples exactly. They vote with a weight that falls with distance, and each for as
    many labelled rows as stand behind it, which makes the score a share of the label.
    """
    spark, rows = docs.sparkSession, keyed(docs)
    voters = spark.sparkContext.broadcast(_voters(docs, labels, label, folds, fold))
    out = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
         ("predicted", pa.int32()), ("evidence", pa.list_(pa.int64()))]
    )

    def vote(batches):
        judge = voters.value
        for batch in batches:
            for chunk in batch_chunks(batch):
                if isinstance(judge, float):
                    found = [(judge, [])] * chunk.num_rows
                else:
                    found = judge.scores(list(chunk_terms(chunk)))
                scores = [s for s, _ in found]
                yield arrays(
                    out, *chunk.columns[:3], scores, [int(s >= 0.5) for s in scores], [e for _, e in found]
                )

    return rows.select("doc_id", "text_key", held_out(rows, folds, fold).alias("held_out"), "text").mapInArrow(
        vote, "doc_id long, text_key long, held_out boolean, score double, predicted int, evidence array<long>"
    )
