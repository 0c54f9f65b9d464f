"""Operator 12: spelling variants of frequent words, by pivotal bigrams."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, batch_chunks, keyed, written

# Fixed value: runs of letters, after A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")

# Words that a task counts before it hands its counts on.
HELD_WORDS = 200_000

# One edit touches at most one of two bigrams that share no letter, and the three rarest bigrams
# of a word always hold two such.
GRAM, PIVOTS = 2, 2
PREFIX = GRAM * (PIVOTS - 1) + 1

# Differences (length, place of a bigram) that one edit can make.
SHIFTS = [(0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)]


def word_counts(docs: DataFrame, min_chars: int, slip: int) -> DataFrame:
    """``word``, ``n``: how often each word of at least ``min_chars`` letters is met."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            for chunk in batch_chunks(batch):
                ids, texts = chunk.column(0).to_pylist(), chunk.column(1).to_pylist()
                for doc, text in zip(ids, texts, strict=True):
                    low = (text or "").encode().lower().decode()
                    own = Counter(w for w in RUN.findall(low) if len(w) >= min_chars)
                    if slip:
                        own = _slipped(own, "" if doc is None else str(doc), slip, min_chars)
                    held.update(own)
                    if len(held) > HELD_WORDS:
                        yield arrays(schema, list(held), list(held.values()))
                        held.clear()
        yield arrays(schema, list(held), list(held.values()))

    part = keyed(docs).select("doc_id", "text").mapInArrow(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def _slipped(words: Counter[str], doc: str, slip: int, min_chars: int) -> Counter[str]:
    """``words`` of one document; those whose checksum ``slip`` divides have lost one letter.

    What a word becomes is not judged again, even where the document has that word, too.
    """
    found: Counter[str] = Counter()
    for word, n in words.items():
        h = zlib.crc32(f"{doc}:{word}".encode())
        if h % slip == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= min_chars:
            found[word] += n
    return found


def pivots(prefix: list[tuple[int, str]], cost: dict[str, int]) -> list[tuple[int, str]]:
    """The PIVOTS bigrams of ``prefix``, disjoint, that are rarest together.

    ``prefix`` is in order of place. ``best[k]`` holds, over the places so far that a bigram at
    the current place does not overlap, the cheapest choice of k bigrams.
    """
    best: list[tuple[int, list]] = [(0, [])] + [(1 << 62, [])] * PIVOTS
    waiting: list[tuple[int, int, tuple[int, list]]] = []
    done = 0
    result = (1 << 62, [])
    for at, gram in prefix:
        while done < len(waiting) and waiting[done][0] <= at - GRAM:
            _, k, choice = waiting[done]
            best[k] = min(best[k], choice)
            done += 1
        for k in range(1, PIVOTS + 1):
            before, chosen = best[k - 1]
            if len(chosen) == k - 1:
                choice = (before + cost[gram], [*chosen, (at, gram)])
                waiting.append((at, k, choice))
                if k == PIVOTS:
                    result = min(result, choice)
    return result[1]


def prefix_of(word: str, cost: dict[str, int]) -> list[tuple[int, str]]:
    """(place, bigram) of the PREFIX rarest bigrams and those that equal the last of them."""
    rank = lambda x: (cost[x[1]], x[1])
    grams = [(i, word[i : i + GRAM]) for i in range(len(word) - GRAM + 1)]
    last = rank(sorted(grams, key=rank)[PREFIX - 1])
    return [x for x in grams if rank(x) <= last]


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of ``words`` (word, n) one edit apart, each once: structs ``a`` < ``b`` of word and n."""
    # letters make few bigrams: 90 letters make 8,100
    grams = words.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))).alias("gram")
    )
    cost = {r.gram: r.n for r in grams.groupBy("gram").agg(F.count("*").alias("n")).toLocalIterator()}
    shared = words.sparkSession.sparkContext.broadcast(cost)
    schema = pa.schema(
        [("word", pa.string()), ("n", pa.int64()), ("size", pa.int32()), ("letters", pa.int64()),
         ("gram", pa.string()), ("at", pa.int32()), ("pivot", pa.bool_())]
    )

    def grams_of(batches):
        cost = shared.value
        for batch in batches:
            rows = []
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prefix = prefix_of(word, cost)
                chosen = set(pivots(prefix, cost))
                letters = 0
                for c in word:
                    letters |= 1 << ord(c) % 63
                rows += [(word, n, len(word), letters, g, i, (i, g) in chosen) for i, g in prefix]
            for a in range(0, len(rows), 50_000):
                yield arrays(schema, *zip(*rows[a : a + 50_000], strict=True))

    index = written(
        words.select("word", "n").mapInArrow(
            grams_of, "word string, n long, size int, letters long, gram string, at int, pivot boolean"
        ),
        "word-grams",
    )
    probes = index.where("pivot").select(
        F.struct("word", "n").alias("x"),
        F.col("letters").alias("x_letters"),
        "gram",
        F.explode(
            F.array(*(F.struct((F.col("size") + s).alias("size"), (F.col("at") + p).alias("at")) for s, p in SHIFTS))
        ).alias("seen"),
    ).select("x", "x_letters", "gram", "seen.*")
    others = index.select(F.struct("word", "n").alias("y"), "letters", "gram", "size", "at")
    found = probes.join(others, ["gram", "size", "at"])
    # one edit takes one letter out of the set and puts one in
    found = found.where(F.bit_count(F.col("x_letters").bitwiseXOR(F.col("letters"))) <= 2)
    found = found.where(F.levenshtein("x.word", "y.word", 1) == 1)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """For each word with a form, the last one reached; every round doubles the steps taken.

    A form is at least twice as frequent as its word, so 64-bit counts bound the rounds.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(on, "root", "left")
        at = written(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "word-roots",
        )
        if not at.where("moved").take(1):
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(
    docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, slip: int = 0
) -> DataFrame:
    """Words of the texts, each with the frequent word it is one edit away from.

    Words are the runs of Latin letters (A-Z lower-cased) of at least ``min_chars`` code points
    (6 or more) that are met ``min_count`` times or more in all texts; repeated rows count each.
    Null and empty texts have none; a null ``doc_id`` is written as nothing in the checksum.
    Other columns do not matter; an empty table has no words. With ``slip``, an occurrence whose
    checksum crc32(doc_id:word) is divided by it loses one letter first.

    Returns word, form, root, n, n_near, form_n as the contract of operator 12 names them.
    ``ratio`` (2 or more) is how much more frequent a form has to be.

    Pivotal grams: every word indexes its three rarest bigrams (its prefix, with ties) and looks
    for two of them, disjoint and rarest together, in the prefixes of others. Of two words one
    edit apart, the one whose prefix ends first keeps a pivot, moved by one place at most, and
    that is in the other's prefix. So the join is on bigram, place and length; letter sets and
    the edit distance verify. A word has at most as many near words as its letters can make.
    """
    if min_chars < GRAM * PIVOTS or ratio < 2:
        raise ValueError("min_chars has to be at least 4 and ratio at least 2")
    words = written(word_counts(docs, min_chars, slip).where(F.col("n") >= min_count), "words")
    pairs = written(near_pairs(words), "near-words")
    sides = [(pairs["a"], pairs["b"]), (pairs["b"], pairs["a"])]
    near = [
        pairs.select(x["word"].alias("word"), x["n"].alias("n"), F.struct(-y["n"], y["word"].alias("near")).alias("best"))
        for x, y in sides
    ]
    near = [f.select("word", "n", F.struct(F.col("best.col1").alias("less"), F.col("best.near").alias("near")).alias("best")) for f in near]
    alone = words.select("word", "n", F.lit(None).cast("struct<less: bigint, near: string>").alias("best"))
    best = alone.union(near[0]).union(near[1]).groupBy("word", "n").agg(
        F.count("best").alias("n_near"), F.min("best").alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    marked = written(
        best.select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "word-forms",
    )
    roots = _roots(marked.where("form is not null"))
    return marked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
