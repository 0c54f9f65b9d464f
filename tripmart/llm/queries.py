"""The operators over the test tables, each with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.decontaminate import find_leaks

    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return find_leaks(docs, benchmark).drop("text_key")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.lines import dedup_lines

    docs = read_table(spark, sf_dir, "documents")
    return dedup_lines(docs, min_docs=10, texts=False).drop("text_key")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.simhash import near_duplicates

    docs = read_table(spark, sf_dir, "documents")
    return near_duplicates(docs, shingle=3, distance=3).drop("text_key", "root")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.licenses import scan_licenses

    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json", 4096)


def op6_impact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.topk import top_k

    return top_k(read_table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.language import identify_languages

    return identify_languages(read_table(spark, sf_dir, "documents"), folds=3, fold=1)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.quality import score_quality

    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return score_quality(docs, labels, "quality", folds=3, fold=1)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.substrings import remove_repeats

    docs = read_table(spark, sf_dir, "documents")
    return remove_repeats(docs, window=20, texts=False).drop("text_key")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.toxicity import score_toxicity

    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return score_toxicity(docs, labels, "toxic", folds=5, fold=0).drop("text_key")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.prefixes import prefix_trie

    turns = read_table(spark, sf_dir, "conversations")
    return prefix_trie(turns, share=5, heads=9).drop("id", "parent_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.spelling import spelling_variants

    docs = read_table(spark, sf_dir, "documents")
    return spelling_variants(docs, min_chars=6, min_count=5, ratio=5, slip=199)


def op13_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.firstfit import pack_first_fit

    packed = pack_first_fit(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json", 4096, end=2)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def queries() -> dict[str, Query]:
    return {
        "op1_benchmark_decontamination": op1_benchmark_decontamination,
        "op2_line_dedup": op2_line_dedup,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_impact_top_k": op6_impact_top_k,
        "op7_language_id": op7_language_id,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_first_fit_packing": op13_first_fit_packing,
    }


def oracle_sql() -> dict[str, str]:
    from tripmart.llm.oracles import ORACLES

    return dict(ORACLES)
