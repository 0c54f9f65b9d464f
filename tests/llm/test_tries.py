"""Operators 11 to 13 against brute force."""

import collections
import hashlib
import random
import re
import zlib

import compare
import numpy as np
import pytest
import rows as R
from pyspark.sql import functions as F

from tripmart.llm import firstfit, prefixes, queries, spelling
from tripmart.llm.oracles import ORACLES
from tripmart.llm.packing import encoder

SF_DIR = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string, path string, depth int, id string, n long, ends string, base long"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 7, "i", 1, "e", 2) for r in rows], TURNS).repartition(5)


def trie(rows, share, heads):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends) per node."""
    token = lambda r, t: (r or "", t or "")
    found = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = token(role, text)
            digest = hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
            found[c].append((turn is not None, turn or 0, digest, (r, t)))
    own = {c: [x[3] for x in sorted(v)] for c, v in found.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % share) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = collections.defaultdict(set), collections.defaultdict(list)
    for c, path in built.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = collections.defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[x] for x in below)
    return [
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            R.sha(",".join(map(str, sorted(ends[p]))).encode()),
        )
        for p, m in members.items()
    ]


def long_turns():
    rng = random.Random(5)
    rows = []
    for c in range(-12, 60):
        if c % 7 == 3:
            continue
        for t in range(rng.randrange(1, 14)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), f"turn {t} {rng.randrange(2)}"))
    # three that share 70 turns, one of them much deeper; copies; a hot first turn
    for c in (100, 105, 110):
        rows += [(c, t, "user", f"deep {t}") for t in range(70)]
    rows += [(110, t, "user", "é" * t) for t in range(70, 150)]
    for c in range(200, 260):
        rows += [(c, 0, "system", "hello"), (c, 1, "user", f"own {c // 20}")]
    # ties, repeated rows, null turns, ids and texts, an empty text, a long text
    rows += [(300, 1, "a", "x"), (300, 1, "a", "x"), (300, 1, "b", "x"), (300, None, None, None), (301, None, "u", "")]
    rows += [(None, 1, "a", "x"), (302, 5, "u", "long " * 500_000)]
    return rows


@pytest.mark.parametrize(("share", "heads"), [(1, 1), (5, 9)])
@pytest.mark.parametrize("block_bytes", [0, 3000, prefixes.BLOCK_BYTES])
def test_prefix_trie(spark, share, heads, block_bytes, monkeypatch):
    if share == 1 and block_bytes == 0:
        block_bytes = 100
    monkeypatch.setattr(prefixes, "LEVELS", 8 if block_bytes else 60)
    monkeypatch.setattr(prefixes, "HELD_BYTES", 2000)
    rows = long_turns()
    if block_bytes < 1000:  # level by level: not so deep
        rows = [r for r in rows if r[1] is None or r[1] < 20]
    got = prefixes.prefix_trie(turns_frame(spark, rows), share, heads, block_bytes)
    assert R.bag(got.drop("id", "parent_id").collect()) == R.bag(trie(rows, share, heads))


def test_prefix_trie_without_rows(spark):
    assert prefixes.prefix_trie(turns_frame(spark, []), 5, 9).collect() == []
    assert prefixes.prefix_trie(turns_frame(spark, [(None, 1, "a", "b")]), 5, 9).collect() == []


def test_prefix_trie_of_the_table(spark):
    found = queries.op11_prefix_trie(spark, SF_DIR)
    assert compare.differences(found, compare.connect(SF_DIR), ORACLES["op11_prefix_trie"]) is None
    got = found.collect()
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert R.bag(got) == R.bag(trie([tuple(r) for r in rows], 5, 9))


def variants(rows, min_count=5, ratio=5, slip=199):
    n = collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}
    masks = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "*" + w[i + 1 :]].add(w)
            masks[w[:i] + w[i + 1 :], "less"].add(w)
    near = collections.defaultdict(set)
    for key, group in masks.items():
        if isinstance(key, str):
            for w in group:
                near[w] |= group - {w}
        elif key[0] in words:
            near[key[0]] |= group
            for w in group:
                near[w].add(key[0])
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, k in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, k, len(near[w]), words[form[w]] if w in form else None))
    return out


def test_spelling_variants_of_the_table(spark):
    found = queries.op12_spelling_variants(spark, SF_DIR)
    assert compare.differences(found, compare.connect(SF_DIR), ORACLES["op12_spelling_variants"]) is None
    got = found.collect()
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert R.bag(got) == R.bag(variants([tuple(r) for r in rows]))


def test_spelling_variants_of_awkward_words(spark):
    rng = random.Random(3)
    rows = R.corpus()
    for k in range(60):
        # few letters: many equal bigrams; accents; chains of forms
        base = "".join(rng.choice("abÀé") for _ in range(rng.randrange(6, 11)))
        rows.append((1000 + k, f"{base} " * 130))
        for _ in range(4):
            at, c = rng.randrange(len(base)), rng.choice(["", "a", "b", "ab", "é"])
            other = base[:at] + c + base[at + 1 :]
            rows.append((2000 + k, f"{other.upper()} " * 20 + f"{other[:-1]}b " * 6))
    rows += [(3000, "aaaaaaaa " * 9), (3001, "aaaaaaa " * 7), (3002, "x" * 3000 + " "), (3003, ("y" * 400 + " ") * 6)]
    rows += [(3100, "wholechain " * 300), (3101, "wholechaim " * 40), (3102, "wholeshaim " * 6)]
    got = spelling.spelling_variants(R.frame(spark, rows), slip=199).collect()
    expected = variants(rows)
    assert R.bag(got) == R.bag(expected)
    assert any(r[2] != r[1] and r[1] for r in expected), "no chain of forms"
    assert spelling.spelling_variants(R.frame(spark, [])).collect() == []
    assert spelling.spelling_variants(R.frame(spark, [(1, None), (2, "")])).collect() == []


def test_a_word_loses_one_letter_only(spark):
    """What a shortened word becomes stays, though the document has a word like it that is shortened."""
    rng, doc, slip = random.Random(5), 7, 3
    cut = lambda w, h: w[: h % len(w)] + w[h % len(w) + 1 :]
    rows = []
    while len(rows) < 5:
        word = "".join(rng.choice("abcdeé") for _ in range(9))
        h = zlib.crc32(f"{doc}:{word}".encode())
        less = cut(word, h)
        g = zlib.crc32(f"{doc}:{less}".encode())
        if h % slip == 0 and g % slip == 0:
            rows += [(doc, f"{word} " * 9 + f"{less} " * 6), (doc, f"{less} {word} " * 5)]
    got = spelling.spelling_variants(R.frame(spark, rows), slip=slip).collect()
    assert R.bag(got) == R.bag(variants(rows, slip=slip))


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(4)
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randrange(3, 7)))
        prefix = [(i, f"g{i}") for i in places]
        cost = {g: rng.randrange(20) for _, g in prefix}
        (a, x), (b, y) = spelling.pivots(prefix, cost)
        least = min(cost[f"g{i}"] + cost[f"g{j}"] for i in places for j in places if j - i >= 2)
        assert b - a >= 2 and cost[x] + cost[y] == least


def naive_first_fit(lengths, capacity):
    bins, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(bins))
        if at == len(bins):
            bins.append([])
            room.append(capacity)
        bins[at].append(i)
        room[at] -= lengths[i]
    return bins


def test_tournament_tree_is_first_fit():
    rng = random.Random(6)
    for n in (0, 1, 2, 3, 50, 300):
        lengths = [rng.randrange(1, 64) for _ in range(n)]
        bins = firstfit.first_fit_decreasing(lengths, 64)
        assert bins == naive_first_fit(lengths, 64)
        closed = firstfit.close_gaps(bins, lengths, 64)
        sizes = [sum(k for *_, k in p) for p in closed]
        assert all(s == 64 or s & (s - 1) == 0 for s in sizes) and sum(sizes) == sum(lengths)
        parts = collections.defaultdict(list)
        for p in closed:
            for i, a, k in p:
                parts[i].append((a, k))
        for i, length in enumerate(lengths):
            at = 0
            for a, k in sorted(parts[i]):
                assert a == at and k > 0
                at += k
            assert at == length


def check_packing(rows, docs, capacity, end):
    """Every id once, sequences gapless, no padding but at a power of two."""
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0
    expected = collections.defaultdict(list)
    for doc, text in docs:
        ids = encoder("word_bpe_49k.json").whole(text or "") + np.array([end], "<u4").tobytes()
        expected[doc].append(ids)
    for doc, own in expected.items():
        found = sorted(pieces.pop(doc))
        if len(own) == 1:
            assert b"".join(x for *_, x in found) == own[0]
            assert {t for _, _, t, _ in found} == {len(own[0]) // 4}
        else:
            assert sum(n for _, n, _, _ in found) == sum(map(len, own)) // 4
    assert not pieces


def test_first_fit_packing(spark):
    rows = [*R.corpus(), (500, "word " * 9000), *[(600 + i % 3, "same copies") for i in range(400)]]
    docs = R.frame(spark, rows)
    for capacity, group in [(4096, 4096), (64, 20), (1, 10)]:
        some = rows if capacity > 1 else rows[30:45]
        frame = docs if capacity > 1 else R.frame(spark, some)
        got = firstfit.pack_first_fit(frame, capacity=capacity, end=2, group_docs=group).collect()
        check_packing(got, some, capacity, 2)
    assert firstfit.pack_first_fit(R.frame(spark, [])).collect() == []
    assert [(r.doc_id, r.length) for r in firstfit.pack_first_fit(R.frame(spark, [(None, None)])).collect()] == [(None, 1)]


def test_first_fit_query(spark):
    got = queries.op13_first_fit_packing(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    sums = got.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n != 4096 for r in sums) <= 12
