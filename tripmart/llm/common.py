"""What the operators on documents share: rows in, tables between steps, sums of array parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import ROWS_PER_TASK, lookup_join
from tripmart.session import scratch_path

# Fixed value: the ASCII white space that all contracts name, [\x20\x09-\x0D].
SPACE = b" \t\n\x0b\x0c\r"

# Rows of a batch are worked on in chunks of about this many bytes of text, so that a task's
# memory does not follow the size of Arrow batches.
CHUNK_BYTES = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``text_key``, whatever else the input has.

    Rows that share ``doc_id`` and text are the same document; rows that share only
    ``doc_id`` are told apart by ``text_key``.
    """
    text = docs["text"].cast("string")
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
    )


def same_document(left: DataFrame, right: DataFrame):
    """Join condition over the columns of ``keyed``; a null ``doc_id`` equals itself."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe when executors are lost."""
    return written_at(df, scratch_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(sizes: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit``; a longer row stands alone."""
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``CHUNK_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    for a, b in chunks(sizes.to_numpy(zero_copy_only=False)):
        yield batch.slice(a, b - a)


def arrays(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def doubling_sum(parts: DataFrame, width: int, dtype: str) -> np.ndarray:
    """Sum of equally long binary vectors in column ``v``, added up in tasks first.

    Returns one vector of ``width`` numbers, whatever the number of rows.
    """
    schema = pa.schema([("v", pa.binary())])

    def add(batches):
        total = np.zeros(width, dtype)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, dtype)
        yield arrays(schema, [total.tobytes()])

    # each task's rows become one; then eight of those at a time
    n = parts.rdd.getNumPartitions()
    parts = parts.mapInArrow(add, "v binary")
    while n > 8:
        n = -(-n // 8)
        parts = parts.repartition(n).mapInArrow(add, "v binary")
    total = np.zeros(width, dtype)
    for row in parts.toLocalIterator():
        total += np.frombuffer(bytes(row.v), dtype)
    return total


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row ``node``, ``root`` per node.

    ``root`` is the smallest node that can be reached. Tasks first shrink their share of the
    edges to a spanning forest; then every node's edges move to its smallest neighbour
    (large-star, small-star), which halves long chains, until nothing changes. Each round
    is written, so lineage stays short. A round has few shuffles: the driver has threads for each
    shuffle and broadcast of a plan, and they outlast the round.
    """
    current = written(_forests(edges), name)
    seen = _state(current)
    while True:
        # both directions of all edges are the most rows that one node can have
        crowded = 2 * seen[0] > ROWS_PER_TASK
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = _with_least(both, crowded).where("b > a")
        large = larger.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        if crowded:  # else worked out for each count of its rows
            large = written(large, name)
        # small-star: of each node's smaller neighbours the smallest becomes the centre
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        moved = _with_least(down, crowded).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        current = written(moved.where("a <> b").distinct(), name)
        state = _state(current)
        if state == seen:
            break
        seen = state
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _state(edges: DataFrame) -> Row:
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def _with_least(edges: DataFrame, crowded: bool) -> DataFrame:
    """``edges`` with the smallest ``b`` of their ``a`` as ``m``; no task takes all rows of a hot ``a``."""
    if not crowded:
        return edges.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # a node that all others hang on is no hot key: its rows are dealt by their other end
    return lookup_join(edges, least, "a", salt_by=["b"], small=False)


def _forests(edges: DataFrame) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def shrink(batches):
        for batch in batches:
            parent: dict[int, int] = {}

            def find(x):
                while (up := parent.setdefault(x, x)) != x:
                    parent[x] = x = parent.setdefault(up, up)
                return x

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
            pairs = [(x, find(x)) for x in list(parent)]
            pairs = [(x, r) for x, r in pairs if x != r]
            yield arrays(schema, [x for x, _ in pairs], [r for _, r in pairs])

    return edges.select("a", "b").mapInArrow(shrink, "a long, b long")
