"""Operator 3: near duplicates by SimHash, found with the generalised pigeonhole principle."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, components, keyed, shuffle_tasks, text_bytes, written

# Fixed value: the seed of the shingle hash.
SEED = 42

# Fingerprints of which the bit correlations and candidate counts are estimated. They choose
# the plan only; every plan finds the same links.
PLAN_SAMPLE = 8_192

# A bucket with more fingerprints is compared block by block.
BLOCK = 2_048

# Cost of a probe (a row to be shuffled and grouped) in comparisons of two fingerprints.
PROBE_COST = 40.0

_PRINTS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("print", pa.int64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit number whose bits are the majority over the hashes of all shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_digest
        pairs = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        digests = b"".join([digest(joined[a:b], SEED) for a, b in pairs])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[at : at + 4096], axis=1).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(rows)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_key and print of each row; null and empty texts have print 0."""

    def take(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                prints = [fingerprint(t, shingle) for t in text_bytes(chunk.column(1))]
                yield arrays(_PRINTS, chunk.column(0), chunk.column(2), prints)

    return keyed(docs).mapInArrow(take, "doc_id long, text_key long, print long")


# The plan: bits in groups, and how many differing bits a probe of each group allows


@lru_cache(maxsize=64)
def masks(bits: tuple[int, ...], allowed: int) -> np.ndarray:
    """For each choice of ``allowed`` bits of a group: the group's other bits."""
    whole = sum(1 << b for b in bits)
    left = [whole & ~sum(1 << b for b in out) for out in combinations(bits, allowed)]
    return np.array(left, np.uint64)


def correlated_groups(sample: np.ndarray, n_groups: int) -> list[tuple[int, ...]]:
    """Bits in groups of about equal size, each grown from the strongest correlations left."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
    bits -= bits.mean(0)
    scale = np.sqrt((bits**2).sum(0))
    bits /= np.where(scale > 0, scale, 1)
    tie = np.abs(bits.T @ bits)
    np.fill_diagonal(tie, 0)
    left, groups = set(range(64)), []
    for k in range(n_groups):
        size = -(-len(left) // (n_groups - k))
        seed = max(sorted(left), key=lambda b: tie[b, sorted(left)].sum())
        group = [seed]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: tie[b, group].sum()))
        left -= set(group)
        groups.append(tuple(sorted(group)))
    return groups


def candidate_cost(sample: np.ndarray, group: tuple[int, ...], allowed: int, n: int) -> float:
    """Estimated work of probing a group: probes, and pairs of fingerprints that meet."""
    if allowed < 0:
        return 0.0
    every = masks(group, allowed)
    some = every[:: max(1, len(every) // 16)]
    meeting = 0.0
    pairs = len(sample) * (len(sample) - 1) / 2
    for mask in some:
        _, sizes = np.unique(sample & mask, return_counts=True)
        met = float((sizes * (sizes - 1.0) / 2).sum()) / max(pairs, 1)
        meeting += max(met, 0.5 ** (len(group) - allowed))
    meeting *= len(every) / len(some)
    return len(every) * n * PROBE_COST + meeting * n * (n - 1) / 2


def plan_probes(
    sample: np.ndarray, n: int, distance: int, group_counts: tuple[int, ...] = (2, 3, 4, 5)
) -> list[tuple[tuple[int, ...], int]]:
    """Groups and thresholds with the least estimated cost.

    Two fingerprints that differ in ``distance`` bits differ in at most t_i bits of some group
    i, if the t_i add up to ``distance`` - groups + 1 (t_i = -1: the group is not probed). For
    each number of groups, dynamic programming over the groups allots the thresholds.
    """
    best: tuple[float, list] | None = None
    for m in group_counts:
        groups = correlated_groups(sample, m)
        budget = distance - m + 1
        # state: sum of thresholds so far, with -1 for each group left out
        states: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for group in groups:
            following: dict[int, tuple[float, list]] = {}
            for spent, (cost, chosen) in states.items():
                for t in range(-1, min(distance, 3) + 1):
                    total = cost + candidate_cost(sample, group, t, n)
                    if spent + t not in following or total < following[spent + t][0]:
                        following[spent + t] = (total, [*chosen, (group, t)])
            states = following
        if budget in states and (best is None or states[budget][0] < best[0]):
            best = states[budget]
    return [(g, t) for g, t in best[1] if t >= 0]


# Probing and verifying


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints at ``distance`` bits or fewer.

    Every pair at that distance is connected by the returned links. Within a bucket not all
    pairs are returned but a spanning forest of the pairs that were verified.
    """
    spark = prints.sparkSession
    distinct = written(prints.select(F.col("print")).distinct(), "distinct-prints")
    n = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("print")).limit(PLAN_SAMPLE).collect()
    sample = np.array([r[0] for r in drawn], np.int64).view(np.uint64)
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    plan = plan_probes(sample, n, distance)
    every = np.concatenate([masks(g, t) for g, t in plan])

    buckets = pa.schema([("bucket", pa.int64()), ("part", pa.int32()), ("print", pa.int64())])

    def probe(batches):
        for batch in batches:
            own = batch.column(0).to_numpy()
            for k, mask in enumerate(every):
                bucket = (own.view(np.uint64) & mask).view(np.int64)
                yield arrays(buckets, bucket, np.full(len(own), k, np.int32), own)

    probed = distinct.mapInArrow(probe, "bucket long, part int, print long")
    sizes = probed.groupBy("bucket", "part").agg(F.count("*").alias("n")).where("n > 1")
    if n > BLOCK:
        large = sizes.where(F.col("n") > BLOCK).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        large = written(large.drop("n"), "large-buckets")
        probed = probed.join(large, ["bucket", "part"], "left")
        block = F.pmod(F.xxhash64("print", F.lit(7)), F.col("blocks")).cast("int")
        # a block meets itself and every other block once
        i = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
        probed = probed.withColumn("own", F.coalesce(block, F.lit(0))).withColumn("other", i)
        probed = probed.select(
            "bucket", "part", "print", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
        )
    else:
        probed = probed.withColumns({"i": F.lit(0), "j": F.lit(0)})
    groups = (
        probed.groupBy("bucket", "part", "i", "j")
        .agg(F.collect_list("print").alias("prints"))
        .where(F.size("prints") > 1)
        .select("prints")
    )

    def verify(batches):
        for batch in batches:
            column = batch.column(0)
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy().view(np.uint64)
            sizes_ = np.diff(offsets)
            out = []
            # pairs of small buckets at once, by their distance in the list
            small = sizes_ <= 16
            where = np.repeat(np.where(small, np.arange(len(sizes_)), -1), sizes_)
            own = values[offsets[0] : offsets[-1]]
            for step in range(1, int(sizes_[small].max(initial=1))):
                a, b = own[:-step], own[step:]
                at = np.flatnonzero((where[:-step] == where[step:]) & (where[step:] >= 0))
                at = at[np.bitwise_count(a[at] ^ b[at]) <= distance]
                out.append((a[at], b[at]))
            for g in np.flatnonzero(~small):
                out.append(_forest(values[offsets[g] : offsets[g + 1]], distance))
            if out:
                a, b = (np.concatenate(x) for x in zip(*out, strict=True))
                yield arrays(_LINKS, a.view(np.int64), b.view(np.int64))

    return groups.mapInArrow(verify, "a long, b long")


def _forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest over the pairs of a block that are at ``distance`` or nearer."""
    n = len(prints)
    new = np.ones(n, bool)
    ends: list[tuple[int, int]] = []
    for seed in range(n):
        if not new[seed]:
            continue
        new[seed] = False
        reached = [seed]
        while reached:
            at = reached.pop()
            open_ = np.flatnonzero(new)
            near = open_[np.bitwise_count(prints[open_] ^ prints[at]) <= distance]
            new[near] = False
            ends += [(at, x) for x in near.tolist()]
            reached += near.tolist()
    if not ends:
        return prints[:0], prints[:0]
    a, b = np.array(ends).T
    return prints[a], prints[b]


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """Component of each document: doc_id, text_key, fingerprint, component_id, root.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a fingerprint bit is
    the majority over the hashes of all shingles. Documents whose fingerprints differ in
    ``distance`` bits or fewer are linked, also null and empty texts (fingerprint 0);
    ``component_id`` is the smallest ``doc_id`` that links reach, null only where no document
    of the component has one. ``root`` is the component's smallest fingerprint as a number, and
    tells components without any ``doc_id`` apart. One row per input row; other columns do not matter.

    Equal fingerprints are one from the start. Distinct ones are probed by the generalised
    pigeonhole principle: correlated bits are grouped, thresholds are allotted by dynamic
    programming, and each fingerprint goes to one bucket per mask. Buckets beyond ``BLOCK``
    fingerprints are split into pairs of blocks, so no task holds a large bucket, and all
    that is returned from a bucket is a spanning forest of its verified links.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    found = components(links(prints, distance), "print-links")
    first = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = first.join(found, first["print"] == found["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(least, "root").select("print", "component_id", "root")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return prints.join(label, "print").select(
        "doc_id", "text_key", digits.alias("fingerprint"), "component_id", "root"
    )
