"""Operator 11: the trie of conversation prefixes, by truncation peeling."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import arrays, written
from tripmart.operators.lookup import lookup_join

# A turn's token: its digest (16 bytes) and the UTF-8 length of its text (8 bytes). A path is the
# tokens of a prefix one after the other, so stripping the last turn shortens it by one token.
DIGEST, TOKEN = 16, 24

# Down to this depth every level is a shuffle of its own; below it one shuffle peels a block of
# levels, where no block of one subtree is larger than BLOCK_BYTES.
LEVELS = 8
BLOCK_BYTES = 16_000_000

# Member ids that a task holds before it hands them on.
HELD_BYTES = 8_000_000

_ENDED = "path binary, first long, n long, ids binary"
_MERGED = "path binary, depth long, conv_id long, n_convs long, ends string"
_NODES = (
    "path binary, id binary, parent_id binary, depth long, conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string"
)
_NODE_SCHEMA = pa.schema(
    [("path", pa.binary()), ("id", pa.binary()), ("parent_id", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string())]
)


def _turns(conversations: DataFrame, share: int) -> DataFrame:
    """One row per turn: its conversation, that of its block of ids, its place and its token."""
    conv = conversations["conv_id"].cast("long")
    role = F.coalesce(conversations["role"].cast("string"), F.lit(""))
    text = F.coalesce(conversations["text"].cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (TOKEN - DIGEST), "0")
    return conversations.where(conv.isNotNull()).select(
        (conv - conv % share).alias("base"),
        conv.alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.unhex(F.concat(digest, size)).alias("token"),
    )


def _ended(share: int, heads: int):
    """Rebuilt conversations of a range of ids as (path, first id, how many, their ids).

    Input in order of base, conversation and turn. Rows of one path are put together, in id
    order, until HELD_BYTES are held.
    """
    schema = pa.schema([("path", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def of_base(base: int, found: dict[int, list[bytes]]) -> Iterator[tuple[int, bytes]]:
        head = found.get(base, [])
        for conv, own in found.items():
            h = zlib.crc32(str(conv).encode()) % heads
            yield conv, b"".join(head[:h] + own[h:])

    def grouped(batches) -> Iterator[tuple[int, bytes]]:
        current, found = None, {}
        for batch in batches:
            base, conv, token = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for b, c, t in zip(base, conv, token, strict=True):
                if b != current:
                    if found:
                        yield from of_base(current, found)
                    current, found = b, {}
                found.setdefault(c, []).append(t)
        if found:
            yield from of_base(current, found)

    def run(batches):
        held, size = {}, 0
        for conv, path in grouped(batches):
            text = str(conv).encode()
            if path not in held:
                held[path] = []
                size += len(path) + 100
            held[path].append(text)
            size += len(text) + 50
            if size > HELD_BYTES:
                yield pieces(held)
                held, size = {}, 0
        yield pieces(held)

    def pieces(held):
        rows = [(p, int(ids[0]), len(ids), b",".join(ids)) for p, ids in held.items()]
        return arrays(schema, *(zip(*rows, strict=True) if rows else [[]] * 4))

    return run


def _merge_ends(batches):
    """Pieces in order of path and first id to one row per path; ids only pass by."""
    schema = pa.schema(
        [("path", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("ends", pa.string())]
    )
    path, first, n, digest = None, 0, 0, None
    for batch in batches:
        rows = []
        for p, f, k, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p == path:
                digest.update(b",")
            else:
                if path is not None:
                    rows.append((path, len(path) // TOKEN, first, n, digest.hexdigest()))
                path, first, n, digest = p, f, 0, hashlib.sha256()
            digest.update(ids)
            n += k
        yield arrays(schema, *(zip(*rows, strict=True) if rows else [[]] * 5))
    if path is not None:
        yield arrays(schema, *([x] for x in (path, len(path) // TOKEN, first, n, digest.hexdigest())))


def _last_size(path: Column) -> Column:
    """UTF-8 length of the last turn's text; the root has none."""
    size = F.conv(F.hex(F.substring(path, DIGEST - TOKEN, TOKEN - DIGEST)), 16, 10).cast("long")
    return F.when(F.octet_length(path) == 0, 0).otherwise(size)


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """What the nodes at ``depth`` add to their parents."""
    return nodes.where(F.col("depth") == depth).select(
        F.substring("path", 1, TOKEN * (depth - 1)).alias("path"),
        "conv_id",
        "n_convs",
        F.lit(1).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.lit(None).cast("string").alias("ends"),
    )


def _newly_ended(merged: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return merged.select(
        "path",
        "conv_id",
        "n_convs",
        zero.alias("n_children"),
        zero.alias("n_leaves"),
        zero.alias("saved_tokens"),
        "ends",
    )


def _regroup(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level out of conversations that end there and stripped deeper nodes."""
    nodes = rows.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends").alias("ends"),
    )
    parent = F.unhex(F.md5(F.substring("path", 1, TOKEN * max(0, depth - 1))))
    return nodes.select(
        "path",
        F.unhex(F.md5("path")).alias("id"),
        (parent if depth else F.lit(None).cast("binary")).alias("parent_id"),
        F.lit(depth).cast("long").alias("depth"),
        "conv_id",
        "n_convs",
        "n_children",
        F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * _last_size(F.col("path"))).alias("saved_tokens"),
        "ends",
    )


def _regroup_block(rows: DataFrame, low: int, high: int) -> DataFrame:
    """The same for levels ``high`` to ``low + 1``, each subtree below ``low`` in one task."""

    def peel(level: dict[int, dict[bytes, list]]):
        for depth in range(high, low, -1):
            for path, (conv, n, children, leaves, saved, ends) in level.pop(depth, {}).items():
                saved += (n - 1) * int.from_bytes(path[DIGEST - TOKEN :], "big")
                leaves = max(leaves, 1)
                parent = path[:-TOKEN]
                ids = hashlib.md5(path).digest(), hashlib.md5(parent).digest()
                yield (path if depth == low + 1 else None, *ids, depth, conv, n, children, leaves, saved, ends)
                if depth > low + 1:
                    add(level, parent, (conv, n, 1, leaves, saved, None))

    def add(level, path, node):
        nodes = level.setdefault(len(path) // TOKEN, {})
        if path in nodes:
            have = nodes[path]
            have[0] = min(have[0], node[0])
            for i in range(1, 5):
                have[i] += node[i]
            have[5] = have[5] or node[5]
        else:
            nodes[path] = list(node)

    def run(batches):
        prefix, level, out = None, {}, []
        for batch in batches:
            for path, *node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path[: TOKEN * low] != prefix:
                    out += peel(level)
                    prefix, level = path[: TOKEN * low], {}
                    if len(out) > 10_000:
                        yield arrays(_NODE_SCHEMA, *zip(*out, strict=True))
                        out = []
                add(level, path, node)
        out += peel(level)
        for a in range(0, len(out), 10_000):
            yield arrays(_NODE_SCHEMA, *zip(*out[a : a + 10_000], strict=True))

    top = F.substring("path", 1, TOKEN * low)
    return rows.repartition(top).sortWithinPartitions("path").mapInArrow(run, _NODES)


def _rounds(merged: DataFrame, block_bytes: int) -> list[tuple[int, int]]:
    """(low, high) of each round, deepest first: levels ``high`` to ``low + 1``, and the root.

    Below LEVELS, blocks reach from one power of two to the next; a block with a subtree beyond
    ``block_bytes`` is peeled level by level, which any subtree can stand.
    """
    deepest = merged.agg(F.max("depth")).first()[0]
    if deepest is None:
        return []
    levels = [(d - 1, d) for d in range(min(deepest, LEVELS), 0, -1)] + [(-1, 0)]
    lows = []
    low = LEVELS
    while low < deepest:
        lows.append(low)
        low *= 2
    if not lows:
        return levels
    # bytes of the paths below each subtree at each block's top
    inside = F.filter(F.array(*map(F.lit, lows)), lambda x: x < F.col("depth"))
    sizes = (
        merged.where(F.col("depth") > LEVELS)
        .select(F.octet_length("path").alias("size"), "path", F.explode(inside).alias("low"))
        .groupBy("low", F.md5(F.substring(F.col("path"), F.lit(1), F.col("low") * TOKEN)))
        .agg(F.sum("size").alias("size"))
        .groupBy("low")
        .agg(F.max("size").alias("size"))
    )
    largest = {r.low: r["size"] for r in sizes.collect()}
    for low in lows:
        high = min(2 * low, deepest)
        if largest[low] <= block_bytes:
            levels.insert(0, (low, high))
        else:
            levels = [(d - 1, d) for d in range(high, low, -1)] + levels
    return levels


def prefix_trie(
    conversations: DataFrame, share: int = 1, heads: int = 1, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per distinct prefix of turns (role, text) of the conversations, the root included.

    Turns are ordered by ``turn``, null first; turns of one place by their digest, so repeated
    rows are turns each. Null roles and texts are empty. Rows without ``conv_id`` belong to no
    conversation and are left out; an empty table has no nodes. Other columns do not matter.

    With ``share`` above 1, conversation c starts with the first crc32(c) % ``heads`` turns of
    conversation c - c % share (those there are), followed by its own after as many.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 as the contract of operator 11 names them, with the node's ``id``
    and ``parent_id`` (MD5 of its path).

    Truncation peeling: conversations that end in the same place become one row first. Then, from
    the greatest depth on, the nodes of a level are what is left of deeper nodes without their
    last turn, regrouped together with the conversations that end there; counts, leaves and saved
    tokens are sums on the way. A level pre-aggregates in its input tasks, so a prefix that a third
    of all conversations share is no hot key. Each round is written. Deep levels go by blocks.

    A conversation's tokens (24 bytes a turn) are held in one task. Ids of members are sorted by
    the range of ids a task rebuilds, and pass through the digest piece by piece.
    """
    turns = _turns(conversations, share)
    order = ["base", "conv_id", F.asc_nulls_first("turn"), "token"]
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        turns.repartitionByRange(n, "base").sortWithinPartitions(*order).mapInArrow(_ended(share, heads), _ENDED)
    )
    ends = pieces.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_merge_ends, _MERGED)
    merged = written(ends.sortWithinPartitions("depth"), "conversations-ended")

    nodes = None
    rounds = []
    for low, high in _rounds(merged, block_bytes):
        depth = F.col("depth")
        rows = _newly_ended(merged.where((depth > low) & (depth <= high)))
        if nodes is not None:
            rows = rows.unionByName(_stripped(nodes, high + 1))
        found = _regroup(rows, high) if low == high - 1 else _regroup_block(rows, low, high)
        nodes = written(found, f"trie-level-{high}")
        rounds.append(nodes)
    if not rounds:
        rounds.append(conversations.sparkSession.createDataFrame([], _NODES))
    trie = rounds[0].drop("path")
    for found in rounds[1:]:
        trie = trie.unionByName(found.drop("path"))
    parents = trie.where("n_children > 0").select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    return lookup_join(trie, parents, "parent_id", salt_by=["id"]).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "id",
        "parent_id",
    )
