"""Operator 8: quality by averaged subword embeddings with a softmax on top."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, keyed
from tripmart.llm.ngrams import code_points, gram_hashes, word_hashes
from tripmart.llm.samples import held_out, labelled_sample

# Hashed vectors: buckets, and numbers in a vector.
LOG2_BUCKETS = 16
BUCKETS = 1 << LOG2_BUCKETS
DIMS = 16
ORDERS = (2, 3, 4)

# Bounds of the fit: labelled documents of each class, passes over them.
PER_CLASS = 2_500
EPOCHS = 6
RATE = 0.5
# Texts learned from at once.
MINIBATCH = 16

# Fixed value: what hashes of words that repeat the word before are replaced with.
AGAIN = np.uint64(0x5DEECE66D1CE4E5B)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of all texts, and which text each is of.

    Case and marks count. A word that repeats the one before it is the word "again".
    """
    points, starts = code_points(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    shift = np.uint64(64 - LOG2_BUCKETS)
    buckets, owner = [], []
    words, first = word_hashes(points)
    if len(words):
        own = doc[first]
        again = np.flatnonzero((words[1:] == words[:-1]) & (own[1:] == own[:-1])) + 1
        words = words.copy()
        words[again] = AGAIN
        buckets.append(words >> shift)
        owner.append(own)
    for n in ORDERS:
        if len(points) >= n:
            inside = doc[: len(points) - n + 1] == doc[n - 1 :]
            buckets.append((gram_hashes(points, n) >> shift)[inside])
            owner.append(doc[: len(points) - n + 1][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owner)


def mean_of(values: np.ndarray, buckets: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Average over each text's features of a number per bucket."""
    total = np.bincount(owner, values[buckets], n)
    return total / np.maximum(np.bincount(owner, minlength=n), 1)


def train(bags: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket vectors, class weights and biases by stochastic gradient descent on cross-entropy.

    A bag is a text's distinct buckets, the share of each, and the class.
    """
    rng = np.random.default_rng(17)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMS)).astype(np.float32) / DIMS
    weights = rng.uniform(-1, 1, (DIMS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), MINIBATCH):
            some = [bags[i] for i in order[at : at + MINIBATCH]]
            rate = np.float32(RATE * (1 - done / steps))
            done += len(some)
            hidden = np.stack([share @ vectors[ids] for ids, share, _ in some])
            logits = hidden @ weights + bias
            logits -= logits.max(1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(some)), [c for _, _, c in some]] -= 1
            back = error @ weights.T
            weights -= rate * hidden.T @ error / len(some) * 4
            bias -= rate * error.mean(0)
            for (ids, share, _), g in zip(some, back, strict=True):
                # a frequent bucket has a small share in each text: its steps are scaled up
                vectors[ids] -= (rate * 4 * np.sqrt(share))[:, None] * g
    return vectors, weights, bias


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, fold: int = 1
) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per input row.

    Null and empty texts are scored as an empty text. Without labelled rows of both classes
    all scores are the share of class 1 (0 without any). Other columns do not matter.

    The model is fitted on a bounded sample of labelled rows outside the fold (``PER_CLASS`` of
    each class): vectors of hashed words and character n-grams, averaged per text, with a
    softmax over two classes, trained by stochastic gradient descent in numpy. The bias is then
    set for the classes' shares among all labelled rows. As the average is linear, a text is
    scored by averaging what each bucket's vector adds to the difference of the two outputs.
    """
    spark = docs.sparkSession
    sample, stand_for = labelled_sample(docs, labels, label, folds, fold, PER_CLASS)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("ids", pa.binary()), ("share", pa.binary())])

    def bag(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                out = []
                for t in chunk.column(2).to_pylist():
                    ids, n = np.unique(features([t or ""])[0], return_counts=True)
                    out.append((ids.astype(np.uint16).tobytes(), (n / max(n.sum(), 1)).astype("f4").tobytes()))
                yield arrays(schema, chunk.column(0), chunk.column(1), *zip(*out, strict=True))

    drawn = sample.mapInArrow(bag, "doc_id long, label int, ids binary, share binary").collect()
    drawn.sort(key=lambda r: (r.doc_id, bytes(r.ids)))
    bags = [
        (np.frombuffer(bytes(r.ids), np.uint16).astype(np.int64), np.frombuffer(bytes(r.share), "f4"), r.label)
        for r in drawn
    ]
    del drawn
    sizes = [sum(stand_for.get(c, 0) for _, _, k in bags if k == c) for c in (0, 1)]
    if all(sizes):
        vectors, weights, bias = train(bags)
        value = vectors @ (weights[:, 1] - weights[:, 0])
        drawn_odds = sum(k for _, _, k in bags) / sum(1 - k for _, _, k in bags)
        base = float(bias[1] - bias[0]) + float(np.log(sizes[1] / sizes[0] / drawn_odds))
    else:
        value, base = np.zeros(BUCKETS, np.float32), (np.inf if sizes[1] else -np.inf)
    shared = spark.sparkContext.broadcast((value.astype(np.float64), base))
    out = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def predict(batches):
        values, start = shared.value
        for batch in batches:
            for chunk in batch_chunks(batch):
                texts = [t or "" for t in chunk.column(2).to_pylist()]
                logit = mean_of(values, *features(texts), len(texts)) + start
                with np.errstate(over="ignore"):
                    score = 1 / (1 + np.exp(-logit))
                yield arrays(out, chunk.column(0), chunk.column(1), score, (score >= 0.5).astype(np.int32))

    rows = keyed(docs)
    return rows.select("doc_id", held_out(rows, folds, fold).alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, score double, predicted int"
    )
