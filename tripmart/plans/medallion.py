"""The gated run: bronze, silver, audit, publish, gold."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.check_states import refresh_checks
from tripmart.operators.checks import Check, gate
from tripmart.plans.audit import run_dq, silver_suite
from tripmart.plans.bronze import run_bronze
from tripmart.plans.gold import run_gold
from tripmart.plans.silver import TIE_BREAKERS, SilverChange, refresh_silver, run_silver
from tripmart.schemas import PARTITION_UNIT
from tripmart.sinks.tables import (
    TRANSACTIONAL,
    load_version,
    load_written,
    overwrite,
    published,
    version_path,
)
from tripmart.sources.tables import read_table


@dataclass
class LakeConfig:
    """Where the layers live and what feeds them."""

    root: str
    zones: DataFrame
    history_path: str | None = None
    stream: DataFrame | None = None
    bronze: DataFrame | None = None
    suite: list[Check] = field(default_factory=silver_suite)
    tie_breakers: Sequence[str] = tuple(TIE_BREAKERS)
    incremental: bool = False
    resolutions: Mapping[str, int] | None = None
    fmt: str = "parquet"
    partition_unit: str = PARTITION_UNIT

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_path(self) -> str:
        return self.path("bronze", "trips")

    @property
    def silver_path(self) -> str:
        return self.path("silver", "trips")

    @property
    def gold_path(self) -> str:
        return self.path("gold")

    @property
    def checkpoint_path(self) -> str:
        return self.path("checkpoints", "bronze_trips")


def run_pipeline(
    spark: SparkSession, cfg: LakeConfig, run_id: str | None = None
) -> dict[str, str] | None:
    """Run all layers; returns the gold paths, or ``None`` while bronze is empty.

    Silver is written, then audited, then published. If the audit fails, `QualityError`
    is raised and readers keep the old silver and the old gold, or none if there were none.
    """
    run_id = run_id or uuid.uuid4().hex
    bronze = cfg.bronze
    if bronze is None:
        bronze = run_bronze(
            spark,
            cfg.bronze_path,
            cfg.history_path,
            cfg.stream,
            cfg.checkpoint_path,
            fmt=cfg.fmt,
        )
    if bronze is None:
        return None
    # A transactional table has no unpublished version, so its rows are staged beside it.
    staged = cfg.fmt in TRANSACTIONAL
    if cfg.incremental and cfg.bronze is None and not staged:
        change = refresh_silver(
            spark,
            cfg.bronze_path,
            cfg.zones,
            cfg.silver_path,
            run_id,
            cfg.tie_breakers,
            cfg.fmt,
            cfg.partition_unit,
        )
    else:
        base = None if staged else published(spark, cfg.silver_path)
        run_silver(
            bronze,
            cfg.zones,
            f"{cfg.silver_path}_staged" if staged else cfg.silver_path,
            run_id,
            cfg.tie_breakers,
            cfg.fmt,
            publish_now=False,
            partition_unit=cfg.partition_unit,
        )
        change = SilverChange(base, run_id, None, None)
    if change.parts is not None:
        audited = load_written(spark, cfg.silver_path, change.run_id, change.parts, cfg.fmt)
    else:
        place = f"{cfg.silver_path}_staged" if staged else version_path(cfg.silver_path, run_id)
        audited = load_version(spark, place, cfg.fmt)
    if cfg.incremental and not staged and change.notes:
        # the gate, too, looks at what changed only
        checked = refresh_checks(
            spark,
            cfg.suite,
            cfg.silver_path,
            f"{cfg.silver_path}_checks",
            run_id,
            change.run_id,
            change.parts,
            change.touched,
            change.base,
            fmt=cfg.fmt,
        )
        gate(checked.report)
        change.publish(spark, cfg.silver_path)
        checked.publish()
    else:
        run_dq(audited, cfg.suite)
        if staged:
            overwrite(audited, cfg.silver_path, run_id, cfg.fmt)
        else:
            change.publish(spark, cfg.silver_path)
    silver = read_table(spark, cfg.silver_path, cfg.fmt)
    return run_gold(
        spark,
        silver,
        cfg.gold_path,
        run_id,
        cfg.fmt,
        cfg.incremental,
        cfg.resolutions,
        cfg.partition_unit,
        cfg.silver_path,
    )
