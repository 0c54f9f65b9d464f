"""Operator 6: exact inner-product search by an impact-ordered index, score at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, written

# Numbers of a shard: its vectors times their length.
SHARD_NUMBERS = 1 << 20

# Shares of a query's segments after which the proof is tried.
STRIDES = (1 / 16, 1 / 8, 1 / 4, 1 / 2)

# Trial queries go through all strides: a shard's first ones, and one in so many later.
TRIALS, TRIAL_EVERY = 8, 64

# Queries that are scored at once where most vectors of a shard are possible.
SCORED = 32

_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(table: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and its vector as integers floor(scale * x), an array of longs.

    Null ids, null vectors and vectors that hold null or non-finite components are left out; of
    rows that repeat an id the vector first in order counts.
    """
    x = F.transform(table["embedding"], lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        table.select(table["vec_id"].cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
        .groupBy("vec_id")
        .agg(F.min("x").alias("x"))
        .select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("x"))
    )


class ImpactIndex:
    """Posting segments of a shard: per dimension, vectors with components of one quantised level."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.n, dims = rows.shape
        largest = int(np.abs(rows).max(initial=0))
        # products are whole numbers that the type holds exactly, unless components are huge
        exact = np.float32 if dims * largest**2 < 1 << 23 else np.float64
        self.exact = rows if dims * largest**2 >= 1 << 52 else rows.astype(exact)
        #: vectors of all segments, one after the other, and where each segment begins
        order = np.argsort(rows, axis=0, kind="stable")
        self.postings = order.T.ravel().astype(np.int32)
        begins, dim, low, high = [], [], [], []
        # quantised by rank, in halves towards both ends: large components make small segments
        halves = self.n >> np.arange(1, max(2, self.n.bit_length()))
        ranks = np.unique(np.concatenate(([0], halves, self.n - halves)))
        ranks = ranks[ranks < self.n]
        for d in range(dims):
            own = rows[order[:, d], d]
            # cuts move to where the component changes
            cuts = np.unique(np.searchsorted(own, own[ranks]))
            begins.append(cuts + d * self.n)
            dim.append(np.full(len(cuts), d))
            low.append(own[cuts])
            high.append(own[np.append(cuts[1:], self.n) - 1])
        self.begins = np.append(np.concatenate(begins), dims * self.n) if begins else np.zeros(1, np.int64)
        self.dim, self.low, self.high = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (dim, low, high))
        self.sizes = np.diff(self.begins)
        #: queries that ended on proof before their last stride
        self.early = 0
        #: queries so far, trials among them, and how many trials ended on proof after each stride
        self.asked = self.trials = 0
        self.ended = [0] * len(STRIDES)

    def scores(self, query: np.ndarray, some: np.ndarray) -> np.ndarray:
        return (self.exact[some] @ query.astype(self.exact.dtype)).astype(np.int64)

    def bounds(self, impact: np.ndarray, done: np.ndarray) -> np.ndarray:
        """The most that each vector can score, if of the segments ``done`` are processed.

        A processed segment adds its impact to its postings' scores. A vector without one in a
        dimension has at most the largest impact that is left there.
        """
        if not len(done):
            return np.zeros(self.n)
        left = impact.copy()
        left[done] = -np.inf
        rest = np.full(self.rows.shape[1], -np.inf)
        np.maximum.at(rest, self.dim, left)
        rest[np.isneginf(rest)] = 0
        size = self.sizes[done]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.begins[:-1][done] - (ends - size), size)
        gained = np.repeat(impact[done] - rest[self.dim[done]], size)
        return rest.sum() + np.bincount(self.postings[at], gained, self.n)

    def possible(self, query: np.ndarray, own_id: int, k: int) -> np.ndarray:
        """Vectors among which the ``k`` best but the query's own are.

        Segments are processed in descending order of impact, the most that a posting of theirs can
        add to a score. After a stride, the vectors that can still reach the k-th best exact score
        known are the possible members. The query ends once they are few, or after half of the
        segments, from where scoring what is possible costs less than going on. That is so sooner
        in a shard where going on ends few queries: queries other than trials do not go on to
        strides after which fewer than an eighth of the trials ended.
        """
        weight = query[self.dim].astype(np.float64)
        impact = np.maximum(weight * self.low, weight * self.high)
        order = np.argsort(-impact, kind="stable")
        possible = np.arange(self.n)
        trial = self.asked < TRIALS or self.asked % TRIAL_EVERY == 0
        self.asked += 1
        self.trials += trial
        last = max((i for i, n in enumerate(self.ended) if 8 * n >= self.trials), default=0)
        for i, share in enumerate(STRIDES if trial else STRIDES[: last + 1]):
            done = order[: max(1, int(share * len(order)))]
            bound = self.bounds(impact, done)
            bound[self.ids == own_id] = -np.inf
            near = np.argpartition(-bound, min(4 * k, self.n - 1))[: 4 * k]
            near = near[bound[near] > -np.inf]
            floor = -np.inf
            if len(near) >= k:
                # doubles of huge products are a little off
                floor = np.sort(self.scores(query, near))[-k] - 1e-12 * np.abs(impact).sum()
            possible = np.flatnonzero((bound >= floor) & (bound > -np.inf))
            if len(possible) <= max(4 * k, self.n // 64):
                self.early += share < STRIDES[-1]
                self.ended[i] += trial
                break
        return possible

    def search_all(self, queries: np.ndarray, own_ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query, ids and scores of the ``k`` best vectors but its own; ties to the smaller id.

        The possible members are scored exactly: that no other vector is a member is proved by its
        bound. Queries for which most vectors are possible are scored together.
        """
        found = []
        for a in range(0, len(queries), SCORED):
            some = queries[a : a + SCORED]
            possible = [self.possible(q, i, k) for q, i in zip(some, own_ids[a : a + SCORED], strict=True)]
            many = [i for i, p in enumerate(possible) if 8 * len(p) >= self.n]
            together = dict(zip(many, some[many].astype(self.exact.dtype) @ self.exact.T, strict=True)) if many else {}
            for i, (query, own) in enumerate(zip(some, possible, strict=True)):
                scores = together[i][own].astype(np.int64) if i in together else self.scores(query, own)
                if len(own) > k:
                    best = np.flatnonzero(scores >= np.partition(scores, len(own) - k)[len(own) - k])
                    own, scores = own[best], scores[best]
                best = np.lexsort((self.ids[own], -scores))[:k]
                found.append((self.ids[own][best], scores[best]))
        return found

    def search(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.search_all(query[None], np.array([own_id]), k)[0]


def top_k(table: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best of all vectors for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; the score is the inner
    product of the integer vectors; only vectors of equal length are compared. Ties go to the
    smaller ``vec_id``; a query without candidates has no row. Other columns do not matter.

    Vectors are dealt into shards of ``SHARD_NUMBERS`` numbers, and every query goes to every
    shard of its length. A task builds the impact-ordered index of a shard once, from the shard's
    vectors, which come first, and then streams the queries past it; the best of all shards are
    ranked at last. Vectors without components score 0 with each other.
    """
    rows = written(integer_vectors(table, scale).withColumn("dims", F.size("x")), "integer-vectors")
    sizes = rows.groupBy("dims").agg(
        F.ceil(F.count("*") * F.greatest("dims", F.lit(1)) / F.lit(SHARD_NUMBERS)).cast("int").alias("shards")
    )
    dealt = rows.join(sizes, "dims")
    shard = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("shards")).cast("int")
    asked = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    queries = dealt.where(F.pmod("vec_id", F.lit(every)) == 0)
    both = dealt.select("dims", shard.alias("shard"), F.lit(False).alias("asks"), "vec_id", "x").union(
        queries.select("dims", asked.alias("shard"), F.lit(True), "vec_id", "x")
    )

    def answer(batches):
        at, index, ids, parts = None, None, [], []
        for batch in batches:
            dims, shards, asks, vec = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            x = batch.column(4).flatten().to_numpy()
            first = np.concatenate(([0], np.cumsum(dims)))
            found = []
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for a, b in zip([0, *change], [*change, len(dims)], strict=True):
                if a == b:
                    continue
                group, own = (dims[a], shards[a]), x[first[a] : first[b]].reshape(b - a, dims[a])
                if group != at:
                    at, index, ids, parts = group, None, [], []
                if not asks[a]:
                    ids.append(vec[a:b])
                    parts.append(own)
                    continue
                if index is None and ids:
                    index = ImpactIndex(np.concatenate(ids), np.concatenate(parts))
                if index is not None:
                    for q, (hit, score) in zip(vec[a:b], index.search_all(own, vec[a:b], k), strict=True):
                        found.append((np.full(len(hit), q), hit, score))
            if found:
                yield arrays(_HITS, *(np.concatenate(c) for c in zip(*found, strict=True)))

    hits = (
        both.repartition("dims", "shard")
        .sortWithinPartitions("dims", "shard", "asks")
        .mapInArrow(answer, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
