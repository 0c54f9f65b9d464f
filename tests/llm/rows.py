"""Small tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns an operator might use for itself
        T.StructField("key", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("text_key", T.StringType()),
        T.StructField("print", T.LongType()),
    ]
)

LINE = "A line that Many documents share"
PASSAGE = " ".join(f"w{i}" for i in range(60))


def corpus() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): shared lines and passages, copies, nulls, empty, long and repeated rows."""
    words = [f"t{(7 * i * i + i) % 997}" for i in range(3000)]
    texts: list[tuple[int | None, str | None]] = []
    for i in range(30):
        own = " ".join(words[80 * i : 80 * i + 70 + i])
        shared = [LINE.upper() + " \t", LINE, f"  {LINE}"][i % 3]
        texts.append((100 + i, f"{own}\n{shared}" if i < 12 else own))
    texts += [
        (1, None), (2, ""), (3, " \n\t\n"), (4, "one"), (5, "one two"), (6, "one two three"),
        (7, PASSAGE), (8, f"before {PASSAGE} after\n{PASSAGE}"), (9, PASSAGE + " changed at the end"),
        (10, "same " * 70), (11, "a\x85b c d e\x1cf"), (12, "\U0001f600 Über İstanbul café"),
        (13, " ".join(words) * 3), (None, PASSAGE), (None, "no id"), (14, "twice"), (14, "twice"),
        (15, "one id"), (15, "two texts"), (200, texts[20][1]), (201, texts[20][1]), (202, texts[20][1] + " x"),
    ]
    return texts


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]], parts: int = 3) -> DataFrame:
    full = [(d, t, "en", None, None if t is None else len(t), "k", -1, "tk", 0) for d, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def line_dedup(rows, min_docs: int = 10) -> list[tuple]:
    space = b" \t\n\x0b\x0c\r"
    key = lambda line: line.strip(space).lower()
    texts = [(t or "").encode().split(b"\n") for _, t in rows]
    seen = defaultdict(set)
    for i, lines in enumerate(texts):
        for line in lines:
            seen[key(line)].add(i)
    drop = {k for k, at in seen.items() if k and len(at) >= min_docs}
    out = []
    for (d, _), lines in zip(rows, texts, strict=True):
        kept = [x for x in lines if key(x) not in drop]
        out.append((d, len(lines), len(lines) - len(kept), sha(b"\n".join(kept))))
    return out


def removed_repeats(rows, window: int = 20) -> list[tuple]:
    """For rows with distinct ids; a null id comes first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            piece = tuple(words[p : p + window])
            if piece in seen:
                gone[p : p + window] = [True] * window
            seen.add(piece)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[i] = (rows[i][0], len(words), sum(gone), sha(b" ".join(kept)))
    return [out[i] for i in range(len(rows))]


def bag(rows) -> list:
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))
