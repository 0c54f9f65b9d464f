"""Operator 7: language of a text by the nearest of several centroids per language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, doubling_sum, keyed, written
from tripmart.llm.ngrams import code_points, gram_hashes, letters_only
from tripmart.llm.samples import fold as fold_of
from tripmart.llm.samples import grouped_sample, held_out

# Dimensions of the hashed n-gram vectors, and their orders.
LOG2_DIMS = 12
DIMS = 1 << LOG2_DIMS
ORDERS = (1, 2, 3)

# Bounds of the fit: documents of each language, and centroids.
PER_LANGUAGE = 1_200
CENTROIDS = 4

# Width of the softmax over cosines.
TEMPERATURE = 0.05

UNKNOWN = "und"

_MODEL = pa.schema(
    [("lang", pa.string()), ("centroid", pa.binary()), ("nearest", pa.float64())]
)


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams, a row per text; n-grams do not reach over word spaces' ends."""
    points, starts = letters_only(*code_points([t.lower() for t in texts]))
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    total = np.zeros(len(texts) * DIMS, np.int64)
    for n in ORDERS:
        if len(points) < n:
            continue
        bucket = (gram_hashes(points, n) >> np.uint64(64 - LOG2_DIMS)).astype(np.int64)
        own = doc[: len(bucket)]
        inside = own == doc[n - 1 :]
        if n == 1:
            inside = inside & (points != 32)
        total += np.bincount((own * DIMS + bucket)[inside], minlength=len(total))
    return total.reshape(len(texts), DIMS)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows**2).sum(1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit_rows(np.log1p(counts.astype(np.float32)) * idf)


def has_letter(texts: list[str]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t)) for t in texts], bool)


def spherical_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit vectors; starts from vectors far apart, so it always ends alike."""
    chosen = [int(np.argmax(rows @ rows.mean(0)))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin((rows @ rows[chosen].T).max(1))))
    centroids = rows[chosen]
    for _ in range(rounds):
        near = np.argmax(rows @ centroids.T, 1)
        sums = np.stack([rows[near == i].sum(0) for i in range(len(centroids))])
        new = unit_rows(sums)
        empty = ~(near[:, None] == np.arange(len(centroids))).any(0)
        new[empty] = centroids[empty]
        if np.allclose(new, centroids, atol=1e-6):
            break
        centroids = new
    return centroids


def fit(rows: DataFrame) -> tuple[np.ndarray, list[tuple[str, np.ndarray, float]]]:
    """IDF and centroids from documents with a known language (doc_id, lang, text)."""
    spark = rows.sparkSession

    def frequency(batches):
        total = np.zeros(DIMS + 1)
        for batch in batches:
            for chunk in batch_chunks(batch):
                texts = [t or "" for t in chunk.column(0).to_pylist()]
                total[:-1] += (gram_counts(texts) > 0).sum(0)
                total[-1] += len(texts)
        yield arrays(pa.schema([("v", pa.binary())]), [total.tobytes()])

    df = doubling_sum(rows.select("text").mapInArrow(frequency, "v binary"), DIMS + 1, "f8")
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + 1
    shared = spark.sparkContext.broadcast(idf)

    def centroids(key, table):
        # a bounded sample of one language
        texts = [t for t in table.column("text").to_pylist() if t and any(map(str.isalpha, t))]
        own = [vectors(gram_counts(texts[i : i + 64]), shared.value) for i in range(0, len(texts), 64)]
        if not own:
            return _MODEL.empty_table()
        own = np.concatenate(own)
        means = spherical_means(own, CENTROIDS)
        cosine = own @ means.T
        near = np.argmax(cosine, 1)
        # a text farther away than nearly all the sample is rejected
        least = [float(np.quantile(cosine[near == i, i], 0.002)) if (near == i).any() else 1.0 for i in range(len(means))]
        return pa.table(
            [[key[0].as_py()] * len(means), [m.astype("f4").tobytes() for m in means], least], schema=_MODEL
        )

    sample = grouped_sample(rows, "lang", PER_LANGUAGE)
    model = sample.groupBy("lang").applyInArrow(centroids, "lang string, centroid binary, nearest double")
    found = [(r.lang, np.frombuffer(bytes(r.centroid), "f4"), r.nearest) for r in model.collect()]
    return idf, sorted(found, key=lambda m: (m[0], m[1].tobytes()))


def identify_languages(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected, one row per input row.

    ``lang_pred`` is the language of the nearest centroid; ``und`` with score 0 if the text is
    null or has no letter, or if nothing could be learned. Equal cosines go to the language
    first in order. ``score`` is the language's share of a softmax over the languages' best
    cosines. ``rejected`` says that the text is farther from its centroid than all but 0.2 % of
    the sample. Other columns than doc_id, text and lang do not matter.

    Learned from documents outside the fold whose ``lang`` is not null: document frequencies
    of the hashed n-grams over all of them, and up to ``CENTROIDS`` spherical k-means centroids
    per language from a bounded sample (``PER_LANGUAGE``). TF-IDF vectors have length 1.
    """
    spark = docs.sparkSession
    rows = keyed(docs).select("doc_id", "text")
    known = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"),
        docs["text"].cast("string").alias("text"),
    ).where(F.col("lang").isNotNull() & (fold_of(F.col("doc_id"), folds) != fold))
    idf, model = fit(known)
    names = sorted({m[0] for m in model})
    shared = spark.sparkContext.broadcast((idf, names, model))
    out = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
         ("score", pa.float64()), ("rejected", pa.bool_())]
    )

    def predict(batches):
        weights, langs, trained = shared.value
        means = np.stack([m[1] for m in trained]) if trained else np.zeros((1, DIMS), np.float32)
        least = np.array([m[2] for m in trained] or [0.0])
        group = np.array([langs.index(m[0]) for m in trained] or [0])
        for batch in batches:
            for chunk in batch_chunks(batch):
                texts = [t or "" for t in chunk.column(2).to_pylist()]
                cosine = vectors(gram_counts(texts), weights) @ means.T
                best = np.argmax(cosine, 1)
                top = np.stack([cosine[:, group == g].max(1) for g in range(group.max() + 1)], 1)
                power = np.exp((top - top.max(1, keepdims=True)) / TEMPERATURE)
                share = power.max(1) / power.sum(1)
                usable = has_letter(texts) & bool(trained)
                lang = np.where(usable, np.array(langs or [UNKNOWN], object)[group[best]], UNKNOWN)
                far = cosine[np.arange(len(best)), best] < least[best]
                yield arrays(
                    out, chunk.column(0), chunk.column(1), lang.tolist(),
                    np.where(usable, share, 0.0).astype(float), far | ~usable,
                )

    return rows.select("doc_id", held_out(rows, folds, fold).alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )
