"""The corpus pipeline: documents in, packed training sequences out, one table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.stages import STAGES, apply

# No SQL: the first stage is a trained classifier. The tests hold each stage against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    return apply(spark, sf_dir, STAGES)
