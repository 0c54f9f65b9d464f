"""The classifiers: held-out accuracy, awkward rows, and parts against brute force."""

import numpy as np
import pytest
import rows as R

from tripmart.llm import queries, toxicity
from tripmart.llm.language import identify_languages
from tripmart.llm.ngrams import code_points, word_hashes
from tripmart.llm.quality import score_quality
from tripmart.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_languages(spark):
    docs = table(spark, "documents").select("doc_id", "lang")
    got = queries.op7_language_id(spark, SF_DIR).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize(("name", "label", "least"), [("op8_quality_classifier", "quality", 0.97), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    labels = table(spark, "labels")
    got = queries.queries()[name](spark, SF_DIR).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in got]) >= least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_awkward_rows(spark):
    docs, labels = R.frame(spark, R.corpus()), table(spark, "labels")
    n = len(R.corpus())
    for got in (score_toxicity(docs, labels), score_quality(docs, labels), identify_languages(docs)):
        got = got.collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == "und" and by_id[4] == "en"


def test_nothing_to_learn_from(spark):
    docs, none = R.frame(spark, [(1, "some text"), (2, None)]), table(spark, "labels").limit(0)
    assert [r.score for r in score_toxicity(docs, none).collect()] == [0, 0]
    assert [r.score for r in score_quality(docs, none).collect()] == [0, 0]
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in identify_languages(unlabelled).collect()} == {"und"}
    empty = docs.limit(0)
    assert score_toxicity(empty, none).count() == score_quality(empty, none).count() == 0
    assert identify_languages(empty).count() == 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        t = np.unique(rng.integers(0, 40, rng.integers(0, 6))).astype(np.int32)
        w = rng.random(len(t)).astype(np.float32)
        vectors.append((t, w / (np.sqrt((w**2).sum()) or 1)))
    whole = np.zeros((700, 40), np.float32)
    for row, (t, w) in zip(whole, vectors, strict=True):
        row[t] = w
    index = toxicity.BlockMaxIndex(vectors, 50)
    for t, w in vectors[:100]:
        if len(t):
            _, cosines = index.nearest(t, w, 24)
            assert np.allclose(cosines, np.sort(whole[:, t] @ w)[::-1][:24], atol=1e-5)


def brute_toxicity(docs, labels, fold=0):
    """Scores of all rows from dictionaries of terms and all cosines."""
    import math
    import re
    import zlib
    from collections import Counter

    def terms(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        return Counter(words) + Counter(("stem", w[: toxicity.STEM]) for w in words if len(w) > toxicity.STEM)

    found = {d: terms(t) for d, t in docs}
    df = Counter(t for c in found.values() for t in c)
    seen, examples = set(), []
    for d in sorted(labels):
        sign = (labels[d], toxicity._signature(dict(docs)[d] or ""))
        if zlib.crc32(str(d).encode()) % 5 != fold and sign not in seen:
            seen.add(sign)
            examples.append(d)
    n = Counter(labels[d] for d in examples)
    taken = Counter(c for d, c in labels.items() if zlib.crc32(str(d).encode()) % 5 != fold)
    held = {c: Counter(t for d in examples if labels[d] == c for t in found[d]) for c in (0, 1)}

    def factor(t):
        pos, neg = held[1][t], held[0][t]
        if pos * n[0] <= neg * n[1]:
            return toxicity.FLOOR
        ratio, both, every = 0, pos + neg, n[0] + n[1]
        for seen, expected in (
            (pos, both * n[1] / every), (neg, both * n[0] / every),
            (n[1] - pos, (every - both) * n[1] / every), (n[0] - neg, (every - both) * n[0] / every),
        ):
            ratio += 2 * seen * math.log(seen / expected) if seen else 0
        return min(1, max(toxicity.FLOOR, ratio / toxicity.SURE))

    def vector(d):
        v = {t: (1 + math.log(c)) * factor(t) * math.log(1 + len(docs) / df[t]) for t, c in found[d].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = {d: vector(d) for d, _ in docs if found[d]}
    stand = {d: taken[labels[d]] / n[labels[d]] for d in examples}
    share = sum(stand[d] * labels[d] for d in examples) / sum(stand.values())
    scores = {}
    for d, _ in docs:
        if not found[d]:
            scores[d] = (share, [])
            continue
        cosine = {e: sum(x * vectors[e].get(t, 0) for t, x in vectors[d].items()) for e in examples}
        near = sorted(examples, key=lambda e: (-cosine[e], e))[: toxicity.NEIGHBOURS]
        votes = {e: stand[e] / (toxicity.BESIDE + max(0, 1 - cosine[e])) ** 3 for e in near}
        average = toxicity.AVERAGE_VOTES * sum(stand.values()) / len(stand)
        scores[d] = ((sum(votes[e] * labels[e] for e in near) + average * share) / (sum(votes.values()) + average), near)
    return scores, vectors


def test_toxicity_is_the_vote_of_all_nearest_examples(spark):
    import random

    rng = random.Random(9)
    common = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    docs = []
    for d in range(140):
        words = rng.choices(common, k=rng.randrange(3, 40))
        if d % 4 == 0:
            words += rng.sample(["nasty", "nastily", "vile", "rotten"], rng.randrange(1, 3))
        docs.append((d, " ".join(words)))
    docs += [(140, None), (141, ""), (142, "12 34 !?"), (143, docs[4][1]), (144, "unseen terms alone"), (145, "Vile " * 50)]
    labels = {d: int(d % 4 == 0) for d in [*range(0, 120), 143]}
    frame = R.frame(spark, docs)
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    expected, vectors = brute_toxicity(docs, labels)
    got = {r.doc_id: r for r in score_toxicity(frame, marks).collect()}
    assert len(got) == len(docs)
    for d, (score, near) in expected.items():
        assert got[d].score == pytest.approx(score, abs=1e-4), d
        assert len(got[d].evidence) == min(3, len(near))
        # the evidence is as near as the nearest, whichever of equals it is
        if near:
            own = lambda e: sum(x * vectors[e].get(t, 0) for t, x in vectors[d].items())
            assert [own(e) for e in got[d].evidence] == pytest.approx([own(e) for e in near[:3]], abs=1e-5)
    assert all(got[d].evidence for d, t in docs if d not in (140, 141, 142))


def test_every_text_with_a_word_is_searched(spark):
    got = queries.op10_toxicity(spark, SF_DIR)
    texts = table(spark, "documents").select("doc_id", "text")
    rows = got.join(texts, "doc_id").select("text", "evidence").collect()
    assert all(len(r.evidence) == 3 for r in rows if any(c.isalpha() for c in r.text or ""))


def test_word_hashes():
    points, starts = code_points(["ab cd", "", "cd\tab  x"])
    values, first = word_hashes(points)
    assert len(values) == 5 and values[0] == values[3] and values[1] == values[2]
    assert len({*values.tolist()}) == 3 and list(np.searchsorted(starts, first, "right")) == [1, 1, 3, 3, 3]
