"""Decontamination, licences, packing and top-k against brute force; the SQL of the queries."""

import bisect
import math
import random
import zlib

import compare
import numpy as np
import pytest
import rows as R

from tripmart.llm import queries
from tripmart.llm.decontaminate import common_subsequence, find_leaks, longest_run, weighted_subsequence
from tripmart.llm.licenses import GAP_WORDS, RULES, SENTENCES, Licences, scan_licenses
from tripmart.llm.packing import Encoder, deal, pack
from tripmart.llm.topk import top_k
from tripmart.llm import topk

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    con = compare.connect(SF_DIR)
    assert compare.differences(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None


def test_leaks(spark):
    rng = random.Random(4)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 4000").limit(300)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clean = {r.doc_id for r in find_leaks(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    background = [t for d, t in rows if d not in clean]
    planted, expected = [], set()
    for k, item in enumerate(items):
        words = item.text.split()
        if k % 2:  # a paraphrase: some words go, some are others
            words = [w if rng.random() > 0.08 else "otherword" for w in words if rng.random() > 0.08]
        host = background[k % len(background)].split()
        at = rng.randrange(len(host) + 1)
        planted.append((10_000 + k, " ".join([*host[:at], *words, *host[at:]])))
        expected.add((10_000 + k, item.item_id))
    table = R.frame(spark, [*((d, t) for d, t in rows if d not in clean), *planted, (1, None), (2, ""), (None, "x")])
    got = {(r.doc_id, r.item_id) for r in find_leaks(table, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    assert len(expected & got) >= 0.95 * len(expected)
    assert got <= expected


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(R.frame(spark, R.corpus()), none).count() == 0
    one = spark.createDataFrame([(1, R.PASSAGE), (2, None), (3, "")], "item_id long, text string")
    assert find_leaks(R.frame(spark, []), one).count() == 0
    got = {(r.doc_id, r.item_id) for r in find_leaks(R.frame(spark, R.corpus()), one).collect()}
    assert got == {(7, 1), (8, 1), (9, 1), (None, 1)}


def test_excerpts_and_long_items(spark):
    """Whole items of any length, and 13 words in a row from anywhere in one; nothing shorter."""
    rng = random.Random(12)
    filler = lambda n: [f"f{rng.randrange(4000)}" for _ in range(n)]
    items = {
        1: [f"long{i}" for i in range(1000)],
        2: [f"mid{i}" for i in range(59)],
        3: [f"tiny{i}" for i in range(7)],
        4: [f"code{i % 40}x{i // 40}" for i in range(300)],
        5: ["common"] * 40 + [f"own{i}" for i in range(12)],
    }
    docs, expected = [], set()

    def plant(words, *items_in):
        d = len(docs)
        text = filler(rng.randrange(40, 400)) + list(words) + filler(rng.randrange(40, 400))
        docs.append((d, " ".join(text)))
        expected.update((d, i) for i in items_in)

    for item in (1, 2, 3, 4):
        for _ in range(6):
            plant(items[item], item)
    for _ in range(12):
        at = rng.randrange(0, 700)
        plant(items[1][at : at + 300], 1)
        plant(items[2][rng.choice([0, 5, 10, 19]) :][:40], 2)
        at = rng.randrange(0, 980)
        plant(items[1][at : at + 20], 1)
        at = rng.randrange(0, 280)
        plant(items[4][at : at + 18], 4)
        # a paraphrase: one word in seven is another
        plant([w if i % 7 else f"other{i}" for i, w in enumerate(items[2])], 2)
    for _ in range(20):
        plant(filler(10))
        plant(items[1][:9])
        plant(items[2][30:39])
        plant(rng.sample(items[2], 30))
    docs.append((len(docs), " ".join(filler(20_000) + items[2] + filler(30_000))))
    expected.add((docs[-1][0], 2))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    rows = find_leaks(R.frame(spark, docs), table).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got - expected == set()
    assert len(got & expected) >= 0.98 * len(expected)
    runs = {(r.doc_id, r.item_id): r.run for r in rows}
    assert all(runs[d, 1] == 1000 for d in range(6))


def test_items_go_by_blocks(spark, monkeypatch):
    from tripmart.llm import decontaminate

    docs, items = R.frame(spark, R.corpus()), [(i, " ".join(f"x{i}y{k}" for k in range(20))) for i in range(9)]
    items.append((50, R.PASSAGE))
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = R.bag(find_leaks(docs, table).select("doc_id", "item_id").collect())
    monkeypatch.setattr(decontaminate, "PROBES", 3)
    assert R.bag(find_leaks(docs, table).select("doc_id", "item_id").collect()) == whole and whole


def test_longest_run():
    rng = np.random.default_rng(1)
    for _ in range(300):
        item, text = (rng.integers(0, 3, rng.integers(0, 30)).astype(np.uint32) for _ in range(2))
        best = 0
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]:
                    n += 1
                best = max(best, n)
        n, i = longest_run(item, text, 4)
        # of words that repeat, the first place of each four is followed
        assert n <= best and (n >= 4) == (best >= 4)
    item = np.arange(100, dtype=np.uint32)
    text = np.concatenate((item[70:90], item[10:50], item[:15]))
    assert longest_run(item, text, 13) == (40, 10)


def test_subsequences():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(0, 5, rng.integers(0, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert common_subsequence(a, b) == table[-1, -1]
        assert math.isclose(weighted_subsequence(a, b, np.ones(len(a))), table[-1, -1] / len(a))


def test_license_rules(spark):
    sentence = {k: v + "." for k, v in SENTENCES.items()}
    mit = [sentence[x] for x in ("mit-grant", "mit-notice", "mit-as-is")]
    docs = [
        (1, "Text.\n" + "\n".join(mit)),
        (2, " ".join([mit[0], "A. B. C.", *mit[1:]])),
        (3, " ".join([mit[0], "other " * (GAP_WORDS + 1), *mit[1:]])),
        (4, " ".join(reversed(mit))),
        (5, "LICENSED under the Apache License, Version 2.0!\nAll rights reserved."),
        (6, None),
        (7, ""),
    ]
    got = {r.doc_id: (r.licenses, r.n_sentences) for r in scan_licenses(R.frame(spark, docs)).collect()}
    assert got == {
        1: ("MIT", 3), 2: ("MIT", 3), 3: ("", 3), 4: ("", 3),
        5: ("Apache-2.0,LicenseRef-reserved", 2), 6: ("", 0), 7: ("", 0),
    }
    licences = Licences(SENTENCES, RULES)
    assert all(any(a in s.encode() for a in licences.anchors) for s in SENTENCES.values()) and len(licences.anchors) < 30
    # every rule is met by its own sentences, each in words of any case, marks and line ends
    for name, ids in RULES:
        text = ",\n// ".join(SENTENCES[i].upper() for i in ids)
        assert name in {hit[0] for hit in licences.apply(licences.sentences(text.encode()))}, ids


def test_licenses_agree_with_sql(spark):
    """Sentences inside others, over marks and line ends, one after the other, and not over empty lines."""
    import duckdb

    from tripmart.llm.oracles import ORACLES

    rng = random.Random(14)
    names = list(SENTENCES)
    docs = [
        (1, "This file is licensed under the MIT License."), (2, "# SPDX-License-Identifier: MIT"),
        (3, "Licensed under the Apache License,\n   Version 2.0 (the \"License\")"),
        (4, "MIT\n\nLicense"), (5, "MIT |\nLicense | the mit\r\nlicense"), (6, None), (7, ""),
        (8, "all rights reservedness. All Rights RESERVED"), (9, "é MIT Licensé, mit license"),
    ]
    for d in range(10, 150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            rule = rng.choice(RULES)[1] if rng.random() < 0.6 else [rng.choice(names)]
            for i in rule:
                words = SENTENCES[i].split()
                if rng.random() < 0.1:
                    words.insert(rng.randrange(len(words)), "odd")
                joints = [" ", ", ", ".\n", "\n# ", " - "] + (["\n\n"] if rng.random() < 0.1 else [])
                parts.append("".join(w + rng.choice(joints) for w in words))
                parts.append("filler " * rng.choice([0, 1, 5, 39, 40, 41]))
        docs.append((d, "".join(parts)))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    got = scan_licenses(R.frame(spark, docs)).drop("spans")
    assert compare.differences(got, con, ORACLES["op4_license_scan"]) is None
    by_id = {r.doc_id: r.licenses for r in got.collect()}
    assert [by_id[i] for i in (1, 2, 3, 4)] == ["MIT", "MIT", "Apache-2.0", ""]


def test_licenses_of_ones_own(spark):
    own = {"a": "the house rules apply", "b": "no ball games"}
    docs = R.frame(spark, [(1, "Here the House Rules apply. No ball games!"), (2, "No ball games. The house rules apply."), (3, "MIT license")])
    got = {r.doc_id: (r.licenses, r.n_sentences) for r in scan_licenses(docs, own, [("House-1.0", ["a", "b"])]).collect()}
    assert got == {1: ("House-1.0", 2), 2: ("", 2), 3: ("", 0)}
    with pytest.raises(ValueError, match="unknown"):
        Licences(own, [("x", ["c"])])
    with pytest.raises(ValueError, match="normal form"):
        Licences({"a": "Not Normal"}, [])
    assert scan_licenses(R.frame(spark, [])).count() == 0


def test_wrapped_licenses(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version {} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details."""
    mpl = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
    apache = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""
    docs = [
        (1, f"The MIT License\n\n{mit}"), (2, gpl.format(3)), (3, gpl.format(2)), (4, mpl), (5, apache),
        (6, "// SPDX-License-Identifier: MIT"), (7, "# SPDX-License-Identifier: GPL-3.0-or-later\n#\n"),
        (8, "# SPDX-License-Identifier: BSD-3-Clause\nint x;"), (9, mit.replace("limitation", "limitation\n")),
    ]
    got = {r.doc_id: r.licenses for r in scan_licenses(R.frame(spark, docs)).collect()}
    assert got == {
        1: "MIT", 2: "GPL-3.0", 3: "GPL-2.0", 4: "MPL-2.0", 5: "Apache-2.0", 6: "MIT", 7: "GPL-3.0", 8: "BSD-3-Clause", 9: "",
    }
    # every known sentence is found when it is wrapped in a comment
    for name, text in SENTENCES.items():
        words = text.split()
        wrapped = "\n".join("# " + " ".join(words[i : i + 7]) for i in range(0, len(words), 7))
        assert [f[1] for f in Licences(SENTENCES, RULES).sentences(wrapped.encode())] == [name]


def sequences_of(rows, capacity):
    """How many pieces' sequences there are, after a look at their offsets; what best fit needs."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), best_fit_sequences([r.length for r in rows], capacity)


def best_fit_sequences(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at == len(gaps):
            n, gap = n + 1, capacity
        else:
            gap = gaps.pop(at)
        bisect.insort(gaps, gap - length)
    return n


def test_packing(spark):
    rows = R.corpus()
    encode = Encoder("word_bpe_49k.json")
    expected = []
    for d, t in rows:
        ids = encode.whole(t or "") + (1).to_bytes(4, "little")
        for i, a in enumerate(range(0, len(ids), 256)):
            part = ids[a : a + 256]
            expected.append((d, i, a // 4, len(part) // 4, zlib.crc32(part)))
    # in one task, and by supersteps over several ranges
    for range_rows in (16_384, 40):
        got = pack(R.frame(spark, rows), capacity=64, range_rows=range_rows).collect()
        assert R.bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == R.bag(expected)
        n, best = sequences_of(got, 64)
        assert n == best if range_rows == 16_384 else best <= n <= best + 1 + best // 50
        assert pack(R.frame(spark, []), range_rows=range_rows).count() == 0


def test_packing_by_supersteps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = pack(docs, range_rows=100).collect()
    n, best = sequences_of(got, 4096)
    assert best <= n <= best + 1
    # many rows of one length are no hot range: (longest, shortest, as many tokens as words)
    same = [(i, "a " * 9) for i in range(300)] + [(i, "a " * 20) for i in range(300, 330)] + [(330, None), (None, "a")]
    n, best = sequences_of(pack(R.frame(spark, same), capacity=64, range_rows=10).collect(), 64)
    assert best <= n <= best + 2


def test_deal_by_rank():
    # task, waiting, longest, gaps, smallest: 3 pieces of 20 take one gap of 45 and part of the next
    assert deal([(0, 0, 0, 3, 45), (1, 3, 20, 1, 19), (2, 9, 9, 0, 0)]) == [
        (1, 0, 3, 2, 0, 0), (2, 0, 2, 2, 1, 0), (2, 2, 7, 5, 0, 2),
    ]
    rng = random.Random(3)
    for _ in range(200):
        sizes, ranges = 4000, []
        for task in range(rng.randint(1, 30)):
            longest = rng.randint(max(1, sizes // 2), sizes)
            ranges.append((task, rng.randint(0, 50), longest, rng.randint(0, 20), sizes := longest))
        dealt = deal(ranges)
        assert len(dealt) <= 2 * len(ranges)
        used, by_task = set(), {t: r for t, *r in ranges}
        for task, a, b, each, source, first in dealt:
            assert source < task and each * by_task[task][1] <= by_task[source][3]
            ranks = {(source, first + i // each) for i in range(b - a)}
            assert not used & ranks and max(r for _, r in ranks) < by_task[source][2]
            used |= ranks


def test_encoder():
    rng = random.Random(8)
    encode = Encoder("word_bpe_49k.json")
    alphabet = [*map(chr, range(1, 0x250)), *"'s 'll 12.,!<|\n ’€é", *map(chr, range(0x300, 0x310)), "\U0001f600"]
    texts = ["".join(rng.choices(alphabet[-40:] if i % 2 else alphabet, k=rng.randint(0, 40))) for i in range(4000)]
    assert encode(texts) == [encode.whole(t) for t in texts]


def _best(ids, rows, query, own, k):
    scores = rows.astype(object) @ query.astype(object)
    hits = sorted((-int(s), int(i)) for i, s in zip(ids, scores, strict=True) if i != own)[:k]
    return [i for _, i in hits], [-s for s, _ in hits]


@pytest.mark.parametrize("kind", ["skewed", "normal", "wide", "huge", "few", "equal", "one"])
def test_index_is_exact_and_stops_on_proof(kind):
    rng = np.random.default_rng(3)
    n, dims = 2000, 32
    rows = np.floor(64 * rng.normal(size=(n, dims)))
    if kind == "skewed":  # a few large components each, as of learned sparse vectors
        rows = np.floor(64 * rng.pareto(1.0, (n, dims)).clip(0, 300) * (rng.random((n, dims)) < 0.15))
    elif kind == "wide":
        rows *= 1000
    elif kind == "huge":
        rows *= 2.0**22
    elif kind == "few":
        rows = rows[:5]
    elif kind == "equal":
        rows[:] = 7
    elif kind == "one":
        rows = rows[:1]
    rows = rows.astype(np.int64)
    ids = rng.permutation(5 * len(rows))[: len(rows)]
    index = topk.ImpactIndex(ids, rows)
    asked = range(0, len(rows), max(1, len(rows) // 40))
    for i in asked:
        got = index.search(rows[i], ids[i], 20)
        assert ([int(x) for x in got[0]], [int(x) for x in got[1]]) == _best(ids, rows, rows[i], ids[i], 20)
    if kind == "skewed":
        assert index.early > 0.6 * len(asked)


@pytest.mark.parametrize("kind", ["normal", "skewed"])
def test_strides_that_end_no_query_are_left_out(kind, monkeypatch):
    rng = np.random.default_rng(5)
    rows = np.floor(64 * rng.normal(size=(3000, 64))) / 8
    if kind == "skewed":
        rows = 64 * rng.pareto(1.0, rows.shape).clip(0, 300) * (rng.random(rows.shape) < 0.15)
    rows = rows.astype(np.int64)
    index, ids, tried = topk.ImpactIndex(np.arange(3000), rows), np.arange(200), []
    bounds = topk.ImpactIndex.bounds
    monkeypatch.setattr(topk.ImpactIndex, "bounds", lambda *a: tried.append(len(a[2])) or bounds(*a))
    got = index.search_all(rows[:200], ids, 20)
    for i in range(0, 200, 7):
        assert ([int(x) for x in got[i][0]], [int(x) for x in got[i][1]]) == _best(np.arange(3000), rows, rows[i], i, 20)
    if kind == "normal":  # the first stride of each, and all strides of the trials
        assert len(tried) <= 200 + 3 * (topk.TRIALS + 200 // topk.TRIAL_EVERY)
    else:
        assert index.early > 0.6 * 200


def test_shards_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4 + i % 3)]) for i in range(300)] + [(400, []), (420, []), (440, [2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = R.bag(top_k(table).collect())
    monkeypatch.setattr(topk, "SHARD_NUMBERS", 64)
    assert R.bag(top_k(table).collect()) == whole and len({r[0] for r in whole}) == 17


def test_top_k(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(i, rows[20][1]) for i in range(200, 240)]  # ties
    rows += [(300, None), (320, [None] * 6), (340, [math.inf] * 6), (360, [1.0]), (None, rows[0][1]), (60, rows[60][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as shard", "2 as score")
    got = top_k(table).collect()
    own = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v and all(isinstance(x, float) and math.isfinite(x) for x in v)}
    expected = []
    for q in [i for i in own if i % 20 == 0]:
        hits = [(-sum(a * b for a, b in zip(own[q], v, strict=True)), i) for i, v in own.items() if i != q and len(v) == len(own[q])]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(hits)[:20])]
    assert R.bag((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == R.bag(expected)
    assert top_k(table.limit(0)).count() == 0
