"""Operator 2: drop lines that many documents share."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import bloom
from tripmart.llm.common import SPACE, arrays, batch_chunks, keyed, same_document, text_bytes, written

_SUSPECTS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("key", pa.string())])


def line_keys(lines: list[bytes]) -> list[bytes]:
    """Lines stripped of ASCII white space at both ends, A-Z in lower case."""
    return [line.strip(SPACE).lower() for line in lines]


def _distinct_keys(text: bytes) -> list[bytes]:
    keys = dict.fromkeys(line_keys(text.split(b"\n")))
    keys.pop(b"", None)
    return list(keys)


def _hashes(keys: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.array([h(k) for k in keys], np.uint64)


def repeated_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """Keys found in ``min_docs`` documents or more: doc_id, text_key, key, owner.

    One row for each document and key. ``owner``: this document is the first that has the
    key, by ``doc_id`` (null first) and text key.
    """
    rows = keyed(docs)

    def insert(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                keys = [k for t in text_bytes(chunk.column(0)) for k in _distinct_keys(t)]
                yield bloom.inserts(_hashes(keys))

    repeats, _ = bloom.repeats(rows.select("text").mapInArrow(insert, bloom.INSERTS), "line-inserts")
    shared = docs.sparkSession.sparkContext.broadcast(repeats)

    def probe(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                per_doc = [_distinct_keys(t) for t in text_bytes(chunk.column(1))]
                keys = [k for ks in per_doc for k in ks]
                doc = np.repeat(np.arange(len(per_doc)), [len(ks) for ks in per_doc])
                at = np.flatnonzero(bloom.suspects(shared.value, _hashes(keys)))
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column(0).take(pa.array(doc[at])),
                        chunk.column(2).take(pa.array(doc[at])),
                        pa.array([keys[i] for i in at.tolist()], pa.binary()).cast(pa.string()),
                    ],
                    schema=_SUSPECTS,
                )

    found = written(
        rows.select("doc_id", "text", "text_key").mapInArrow(
            probe, "doc_id long, text_key long, key string"
        ),
        "line-suspects",
    )
    confirmed = (
        found.groupBy("key")
        .agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "text_key")).alias("first"))
        .where(F.col("n_docs") >= min_docs)
    )
    return (
        found.join(confirmed, "key")
        .select(
            "doc_id", "text_key", "key",
            F.struct("doc_id", "text_key").eqNullSafe(F.col("first")).alias("owner"),
        )
    )


def _drops(docs: DataFrame, min_docs: int) -> DataFrame:
    """For each document with repeated lines: their keys, and those it is the first to have."""
    return (
        repeated_lines(docs, min_docs)
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_set("key").alias("keys"),
            F.collect_set(F.when(F.col("owner"), F.col("key"))).alias("owned"),
        )
    )


def _kept(text: bytes, keys: list[str] | None, owned) -> tuple[int, list[bytes]]:
    """Number of lines, and the lines that stay; the first line with an owned key stays."""
    lines = text.split(b"\n")
    if not keys:
        return len(lines), lines
    drop, own = {k.encode() for k in keys}, {k.encode() for k in owned}
    kept = []
    for line, key in zip(lines, line_keys(lines), strict=True):
        if key not in drop:
            kept.append(line)
        elif key in own:
            own.discard(key)
            kept.append(line)
    return len(lines), kept


def without_repeated_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` with all its columns and rows, and repeated lines dropped from ``text``.

    As `dedup_lines`, in one join. A text without such lines stays as it is, null too; where lines
    go, ``n_chars`` (if there is one) is counted anew.
    """
    drops, names = _drops(docs, min_docs), docs.columns
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in names)).alias("row"),
        docs["doc_id"].cast("long").alias("row_id"),
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("row_key"),
    )
    here = rows["row_id"].eqNullSafe(drops["doc_id"]) & (rows["row_key"] == drops["text_key"])
    added = "keys"
    while added in map(str.lower, names):
        added += "_"
    rows = rows.join(drops, here, "left").select("row.*", F.col("keys").alias(added))
    text_at, n_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                columns, keys = chunk.columns[:-1], chunk.column(len(names)).to_pylist()
                texts, counts = columns[text_at].to_pylist(), None
                if n_at is not None:
                    counts = columns[n_at].to_pylist()
                for i, drop in enumerate(keys):
                    if drop:
                        texts[i] = b"\n".join(_kept((texts[i] or "").encode(), drop, ())[1]).decode()
                        if counts is not None:
                            counts[i] = len(texts[i])
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if counts is not None:
                    columns[n_at] = pa.array(counts, columns[n_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, docs.schema)


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", texts: bool = True
) -> DataFrame:
    """Drop the lines whose key is found in ``min_docs`` documents or more.

    Texts are split at \\n; a null or empty text is one empty line, and empty keys stay.
    ``keep="first"`` leaves the first line with the key in the first document that has it.
    Returns doc_id, text_key, n_lines, n_dropped, kept_sha256 and, with ``texts``, kept, one
    row per input row. Rows that repeat a document count each on their own. Other columns of
    the input do not matter.

    Two Bloom filters over the hashes of all lines (seen once, seen twice) name the suspects.
    Only lines they suspect are shuffled, to be counted exactly by their text. The filter is
    at most 32 MiB; a denser one means more suspects, not other results.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"unknown keep {keep!r}: expected 'none' or 'first'")
    rows, drops = keyed(docs), _drops(docs, min_docs)
    joined = rows.join(drops, same_document(rows, drops), "left").select(
        rows["doc_id"], rows["text_key"], rows["text"], "keys", "owned"
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_lines", pa.int64()),
         ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
        + [("kept", pa.string())] * texts
    )

    def cut(batches):
        for batch in batches:
            for chunk in batch_chunks(batch):
                out = []
                for text, keys, owned in zip(
                    text_bytes(chunk.column(2)), chunk.column(3).to_pylist(), chunk.column(4).to_pylist(), strict=True
                ):
                    n, kept = _kept(text, keys, owned if keep == "first" else ())
                    whole = b"\n".join(kept)
                    out.append((n, n - len(kept), hashlib.sha256(whole).hexdigest(), whole))
                columns = list(zip(*out, strict=True))
                more = [pa.array(columns[3], pa.binary()).cast(pa.string())] * texts
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), chunk.column(1),
                     *(pa.array(c, t.type) for c, t in zip(columns[:3], list(schema)[2:5], strict=True)), *more],
                    schema=schema,
                )

    fields = "doc_id long, text_key long, n_lines long, n_dropped long, kept_sha256 string"
    return joined.mapInArrow(cut, fields + ", kept string" * texts)
