"""Bounded, repeatable samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import keyed

# Steps into which the hash that draws rows is cut.
STEPS = 1 << 20


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds


def held_out(docs: DataFrame, folds: int, fold_: int) -> Column:
    return F.coalesce(fold(docs["doc_id"], folds) == fold_, F.lit(False))


def _draw() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(STEPS))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold_: int, per_class: int
) -> tuple[DataFrame, dict[int, float]]:
    """Texts of labelled documents outside a fold, about ``per_class`` of each class at most.

    Returns doc_id, label, text and, for each class, how many labelled rows stand behind one
    that was drawn. Rows are drawn by a hash of ``doc_id``; a document labelled twice has the
    larger label. The drawn labels are bounded by ``per_class``, so they are broadcast.
    """
    rows = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
        .where("label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .where(fold(F.col("doc_id"), folds) != fold_)
    )
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rates = {c: min(1.0, per_class / n) for c, n in counts.items()}
    if not rates:
        return keyed(docs).selectExpr("doc_id", "0 as label", "text").limit(0), {}
    bound = F.create_map(*(x for c, r in rates.items() for x in (F.lit(c), F.lit(int(r * STEPS)))))
    drawn = rows.where(_draw() < bound[F.col("label")])
    texts = keyed(docs).select("doc_id", "text")
    sample = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text")
    return sample, {c: 1 / r for c, r in rates.items()}


def grouped_sample(rows: DataFrame, group: str, per_group: int) -> DataFrame:
    """About ``per_group`` rows of each group at most, drawn by a hash of ``doc_id``."""
    counts = {r[0]: r[1] for r in rows.groupBy(group).agg(F.count("*")).collect()}
    if not counts:
        return rows
    bound = F.create_map(
        *(x for g, n in counts.items() for x in (F.lit(g), F.lit(int(min(1.0, per_group / n) * STEPS))))
    )
    return rows.where(_draw() < bound[F.col(group)])
