"""Line dedup, SimHash and substring dedup against brute force."""

import random

import numpy as np
import pytest
import rows as R
import xxhash
from pyspark.sql import functions as F

from tripmart.llm import bloom, common, simhash
from tripmart.llm.fmindex import FmIndex, earliest_occurrences
from tripmart.llm.lines import dedup_lines
from tripmart.llm.substrings import remove_repeats


@pytest.fixture(scope="module")
def docs(spark):
    return R.frame(spark, R.corpus()).cache()


def test_lines(docs):
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert R.bag(got) == R.bag(R.line_dedup(R.corpus()))
    assert sum(r.n_dropped for r in got) == 12


def test_first_line_stays(docs):
    got = {r.doc_id: r for r in dedup_lines(docs, keep="first").collect()}
    assert got[100].n_dropped == 0 and got[101].n_dropped == 1


def test_unknown_keep(docs):
    with pytest.raises(ValueError):
        dedup_lines(docs, keep="last")


def test_filter_names_every_repeat(spark):
    rng = np.random.default_rng(1)
    once = rng.integers(0, 2**63, 20000).astype(np.uint64) * np.uint64(2)
    twice = once[:3000]
    batches = [once[:10000], once[10000:], twice]
    rows = [r for b in batches for r in bloom.inserts(b).to_pylist()]
    table = spark.createDataFrame([(r["segment"], r["n"], r["hashes"]) for r in rows], bloom.INSERTS)
    found = bloom.suspects(bloom.seen_twice(table), once)
    assert found[:3000].all() and found[3000:].mean() < 0.02


def test_simhash(docs):
    rows = R.corpus()

    def fingerprint(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    expected = [(d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)]
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert R.bag(got) == R.bag(expected)


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_probes_find_every_pair(distance):
    rng = np.random.default_rng(distance)
    own = rng.integers(0, 2**63, 300).astype(np.uint64)
    own[:, None]
    flips = [x ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, distance, False).astype(np.uint64)) for x in own]
    for n in (10, 10**6, 10**11):
        plan = simhash.plan_probes(own, n, distance)
        for x, y in zip(own, flips, strict=True):
            assert any(((x ^ y) & m) == 0 for g, t in plan for m in simhash.masks(g, t))


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 4)
    prints = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (60, 2))}
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    got = simhash.components(simhash.links(table, 3), "t").collect()
    root = {r.node: r.root for r in got}
    own = sorted(prints)
    parent = {p: p for p in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in own:
        for b in own:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in own} == {p: root.get(p, p) for p in own}


@pytest.mark.parametrize("crowded", [False, True])
def test_components(spark, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(common, "ROWS_PER_TASK", 10)
    rng = np.random.default_rng(6)
    edges = [(0, x) for x in range(1, 40)]  # a node that many hang on
    edges += [(x + 1, x) for x in range(100, 160)]  # a chain
    edges += [(int(a), int(b)) for a, b in rng.integers(200, 500, (200, 2)) if a != b] + [(7, 0), (0, 7)]
    shuffles, whole = [], common.written
    monkeypatch.setattr(common, "written", lambda df, name: shuffles.append(_exchanges(df)) or whole(df, name))
    rows = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {r.node: r.root for r in common.components(rows, "t").collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert {x: got.get(x, x) for x in parent} == parent
    # a round's plan stays small: the driver keeps threads for each shuffle and broadcast
    if not crowded:
        assert max(shuffles[1:]) <= 4
    empty = spark.createDataFrame([], "a long, b long")
    assert common.components(empty, "t").count() == 0


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def distinct_ids():
    rows, seen = [], set()
    for d, t in R.corpus():
        if d not in seen:
            rows.append((d, t))
            seen.add(d)
    return rows


def test_substrings(spark):
    rows = distinct_ids()
    got = remove_repeats(R.frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    expected = R.removed_repeats(rows)
    assert R.bag(got) == R.bag(expected)
    assert sum(r[2] for r in expected) > 300


def test_repeated_rows_have_one_result(spark):
    text = R.PASSAGE + " end"
    got = remove_repeats(R.frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 61)]


def test_backward_search():
    rng = np.random.default_rng(5)
    text = np.concatenate([np.append(0, rng.integers(1, 4, n)) for n in (30, 50, 8, 40)])
    at = np.array([1, 32, 83, 92])
    sizes = np.array([30, 50, 8, 40])
    index = FmIndex(text, 6)
    count = 0
    for piece, offset, earliest in earliest_occurrences(index, text, at, sizes):
        for p, o, e in zip(piece, np.broadcast_to(offset, piece.shape), earliest, strict=True):
            window = text[at[p] + o : at[p] + o + 6]
            first = next(i for i in range(len(text)) if (text[i : i + 6] == window).all() and i + 6 <= len(text))
            assert first == e
            count += 1
    assert count == sum(max(0, n - 5) for n in sizes)


def test_empty_tables(spark):
    none = R.frame(spark, [])
    assert dedup_lines(none).count() == remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_a_hot_phrase_is_split_by_its_windows(spark, monkeypatch):
    """A short phrase in many documents with other words around it, some of which are copies."""
    from tripmart.llm import substrings

    rng = random.Random(21)
    phrase = [f"hot{i}" for i in range(10)]
    rows = []
    for d in range(3000):
        text = [f"w{rng.randrange(50_000)}" for _ in range(30)] + phrase + [f"w{rng.randrange(50_000)}" for _ in range(30)]
        rows.append((d, " ".join(text)))
    for d in range(3000, 3040):  # whole copies, and copies of what is around the phrase
        other = rows[rng.randrange(3000)][1].split()
        rows.append((d, " ".join(other if d % 2 else [*other[20:50], "new", *other[50:]])))
    docs = R.frame(spark, rows, 8)

    def imbalance():
        sent, shards = substrings.suspected_windows(docs, 20)
        sizes = [r.n or 0 for r in sent.groupBy("shard").agg(F.sum(F.octet_length("words")).alias("n")).collect()]
        return max(sizes) * shards / sum(sizes)

    monkeypatch.setattr(substrings, "SHARD_WORDS", 40_000)
    monkeypatch.setattr(substrings, "HOT_WORDS", 10**9)
    assert imbalance() > 3
    monkeypatch.setattr(substrings, "HOT_WORDS", 10_000)
    assert imbalance() < 1.5
    got = remove_repeats(docs, window=20, texts=False).drop("text_key").collect()
    assert R.bag(got) == R.bag(R.removed_repeats(rows))
