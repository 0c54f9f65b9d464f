"""The stages of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """The whole row as ``row``, so that no column of it clashes, its id and its text's key."""
    return docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        docs["doc_id"].cast("long").alias("row_id"),
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("row_key"),
    )


def _here(rows: DataFrame, found: DataFrame):
    return rows["row_id"].eqNullSafe(found["doc_id"]) & (rows["row_key"] == found["text_key"])


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that are not among ``found``."""
    rows, out = _keyed_rows(docs), found.select("doc_id", "text_key")
    return rows.join(out, _here(rows, out), "left_anti").select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; rows with one ``doc_id`` are judged each."""
    from tripmart.llm.toxicity import score_toxicity

    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that ten documents or more share; every document stays."""
    from tripmart.llm.lines import without_repeated_lines

    return without_repeated_lines(docs, min_docs=10)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest ``doc_id``.

    Near duplicates are those of operator 3 with its contract's parameters: fingerprints of
    three words that differ in three bits or fewer, and what such links reach. Documents without
    an id come last; rows with one ``doc_id`` and different texts are documents of their own.
    """
    from tripmart.llm.simhash import near_duplicates

    found = near_duplicates(docs, shingle=3, distance=3)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    one = found.groupBy("root").agg(F.min(place).alias("first")).select("first.doc_id", "first.text_key")
    rows = _keyed_rows(docs)
    kept = rows.join(one, _here(rows, one), "left_semi")
    # rows that repeat a document wholly are one
    return kept.dropDuplicates(["row_id", "row_key"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    from tripmart.llm.decontaminate import find_leaks

    return _without(docs, find_leaks(docs, read_table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    from tripmart.llm.packing import pack

    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]


def apply(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
