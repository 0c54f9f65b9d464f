"""Data quality checks.

A suite is a list of `Check`. `evaluate` computes all checks of a suite in one pass over the
table: rows are counted per key inside the input tasks, and the measures of the column checks
travel along as partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = [
    "check_name",
    "column_name",
    "element_count",
    "unexpected_count",
    "observed_value",
    "success",
]


@dataclass(frozen=True)
class Check:
    """One check. ``kind`` is one of

    ==================  =============================================================
    ``exists``          the column is there
    ``not_null``        no NULLs
    ``between``         ``low <= value <= high``; NULLs pass
    ``regex``           the value matches ``pattern``; NULLs pass
    ``unique``          no two rows agree on all ``columns``
    ``row_count``       more than ``above`` rows
    ``duplicates``      number of distinct values that occur more than once is 0
    ``minimum``         smallest value ``>= low``
    ``maximum``         greatest value ``< below``
    ``type``            the column has the Spark type ``type``
    ==================  =============================================================
    """

    kind: str
    columns: tuple[str, ...] = ()
    limits: dict[str, Any] = field(default_factory=dict)

    def __init__(self, kind: str, columns: str | Sequence[str] = (), **limits: Any):
        if kind not in _KINDS:
            raise ValueError(f"unknown check {kind!r}")
        object.__setattr__(self, "kind", kind)
        object.__setattr__(
            self, "columns", (columns,) if isinstance(columns, str) else tuple(columns)
        )
        object.__setattr__(self, "limits", limits)

    @property
    def column(self) -> str:
        return ",".join(self.columns)


_KINDS = {
    "exists",
    "not_null",
    "between",
    "regex",
    "unique",
    "row_count",
    "duplicates",
    "minimum",
    "maximum",
    "type",
}
_KEYED = {"unique", "duplicates"}


class QualityError(Exception):
    """A suite failed. ``failures`` holds the failed rows of the report."""

    def __init__(self, failures: list[dict[str, Any]]):
        self.failures = failures
        names = ", ".join(f"{f['check_name']}({f['column_name']})" for f in failures)
        super().__init__(f"quality checks failed: {names}")


def _row(
    check: Check, elements: Column, unexpected: Column, observed: Column, success: Column
) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        elements.cast("long").alias("element_count"),
        unexpected.cast("long").alias("unexpected_count"),
        observed.cast("double").alias("observed_value"),
        success.alias("success"),
    )


def _measure(check: Check) -> Column:
    """The aggregate a column check is decided on."""
    limits = check.limits
    if check.kind in ("exists", "row_count", "type"):
        return F.count(F.lit(1))
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return F.count_if(value.isNull())
    if check.kind == "between":
        return F.count_if(~value.between(limits["low"], limits["high"]))
    if check.kind == "regex":
        return F.count_if(~value.rlike(limits["pattern"]))
    return F.min(value) if check.kind == "minimum" else F.max(value)


def _decide(check: Check, df: DataFrame, rows: Column, measured: Column) -> Column:
    nothing = F.lit(None)
    if check.kind in ("exists", "type") or any(c not in df.columns for c in check.columns):
        ok = all(c in df.columns for c in check.columns)
        if ok and check.kind == "type":
            ok = df.schema[check.columns[0]].dataType.simpleString() == check.limits["type"]
        elif check.kind != "exists":
            ok = False
        return _row(check, rows, F.lit(0) if ok else rows, nothing, F.lit(ok))
    if check.kind == "row_count":
        return _row(check, rows, nothing, measured, measured > check.limits["above"])
    if check.kind == "minimum":
        ok = F.coalesce(measured >= check.limits["low"], F.lit(False))
        return _row(check, rows, nothing, measured, ok)
    if check.kind == "maximum":
        ok = F.coalesce(measured < check.limits["below"], F.lit(False))
        return _row(check, rows, nothing, measured, ok)
    return _row(check, rows, measured, nothing, measured == 0)


def _present(df: DataFrame, check: Check) -> bool:
    return all(c in df.columns for c in check.columns)


def _merged(kind: str, name: str) -> Column:
    """A measure of parts put together."""
    if kind in ("minimum", "maximum"):
        return (F.min if kind == "minimum" else F.max)(name).alias(name)
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def _bad_rows(check: Check, n: str) -> Column:
    """What a group of rows that agree in the key adds to what a keyed check counts."""
    repeated = F.col(n) > 1
    if check.kind == "unique":
        return F.when(repeated, F.col(n)).otherwise(0)
    # a key of nothing but NULL is not a value
    known = reduce(Column.__or__, [F.col(c).isNotNull() for c in check.columns])
    return F.when(repeated & known, 1).otherwise(0)


def _known_rows(check: Check, n: str) -> Column:
    if check.kind == "unique":
        return F.col(n)
    known = reduce(Column.__or__, [F.col(c).isNotNull() for c in check.columns])
    return F.when(known, F.col(n)).otherwise(0)


def _one_pass(df: DataFrame, plain: Sequence[Check], keyed: Sequence[Check]) -> DataFrame:
    """Report over keyed checks whose keys contain each other, finest first, and column checks."""
    kinds = {"rows": "row_count"}
    measures = {"rows": F.count(F.lit(1))}
    for i, check in enumerate(plain):
        if _present(df, check):
            kinds[f"m{i}"], measures[f"m{i}"] = check.kind, _measure(check)
    first = [value.alias(name) for name, value in measures.items()]
    grouped, levels = df, list(dict.fromkeys(check.columns for check in keyed))
    for level, columns in enumerate(levels):
        parts = first if not level else [_merged(kind, name) for name, kind in kinds.items()]
        count = F.count(F.lit(1)) if not level else F.sum("_n")
        grouped = grouped.groupBy(*columns).agg(count.alias("_n"), *parts)
        for k, check in enumerate(keyed):
            if check.columns == columns:
                grouped = grouped.withColumn(f"b{k}", _bad_rows(check, "_n"))
                grouped = grouped.withColumn(f"k{k}", _known_rows(check, "_n"))
                kinds[f"b{k}"] = kinds[f"k{k}"] = "unique"
    if levels:
        measured = grouped.agg(*[_merged(kind, name) for name, kind in kinds.items()])
    else:
        measured = grouped.agg(*first)
    results = [
        _decide(check, df, F.col("rows"), F.col(f"m{i}") if f"m{i}" in kinds else F.lit(None))
        for i, check in enumerate(plain)
    ]
    results += [
        _row(check, F.col(f"k{k}"), F.col(f"b{k}"), F.lit(None), F.col(f"b{k}") == 0)
        for k, check in enumerate(keyed)
    ]
    return measured.select(F.inline(F.array(*results)))


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One report row per check, from one pass over ``df``.

    Keyed checks share the pass as far as their keys contain each other, such as (id, time) and
    (id); a check with a key of its own takes one more.
    """
    keyed = [c for c in checks if c.kind in _KEYED and _present(df, c)]
    plain = [c for c in checks if c not in keyed]
    chain: list[Check] = []
    for check in sorted(keyed, key=lambda c: -len(c.columns)):
        if not chain or set(check.columns) <= set(chain[-1].columns):
            chain.append(check)
    parts = [_one_pass(df, plain, chain)]
    parts += [_one_pass(df, [], [check]) for check in keyed if check not in chain]
    return reduce(DataFrame.unionByName, parts)


def verdict(report: DataFrame) -> DataFrame:
    """Number of checks, number of failures, and whether the suite passed."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


def gate(report: DataFrame) -> list[dict[str, Any]]:
    """Run the checks; raise `QualityError` if any failed. One row per check is collected."""
    rows = [row.asDict() for row in report.collect()]
    failures = [row for row in rows if not row["success"]]
    if failures:
        raise QualityError(failures)
    return rows


def orphans(fact: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Fact rows whose key is not in the dimension: ``(orphan_keys, orphan_rows)``.

    ``on`` maps fact columns to dimension columns; a key with a NULL counts as an orphan.
    The fact is reduced to one row per key inside the input tasks, so the join sees
    distinct keys only and a hot key costs no more than a rare one.
    """
    return orphans_of(fact, {"": (dim, on)}).drop("relation")


def orphans_of(fact: DataFrame, relations: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """`orphans` of several dimensions from one pass: ``(orphan_keys, orphan_rows, relation)``.

    The fact is first reduced to one row per combination of all keys, then to one row per
    relation and key.
    """
    columns = list(dict.fromkeys(name for _, on in relations.values() for name in on))
    combined = fact.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))

    def tagged(name: str, keys: Sequence[str]) -> list[Column]:
        # a NULL in the key leaves no text to be found
        values = F.array(*[F.col(key).cast("string") for key in keys])
        known = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
        return [F.lit(name).alias("relation"), values.alias("key"), known.alias("known")]

    rows = [F.struct(*tagged(name, list(on)), F.col("n")) for name, (_, on) in relations.items()]
    keys = (
        combined.select(F.inline(F.array(*rows)))
        .groupBy("relation", "key", "known")
        .agg(F.sum("n").alias("n"))
    )
    listed = reduce(
        DataFrame.unionByName,
        [
            dim.select(*tagged(name, list(on.values()))).filter("known").drop("known")
            for name, (dim, on) in relations.items()
        ],
    ).distinct()
    missing = keys.join(listed.withColumn("known", F.lit(True)), ["relation", "key", "known"], "left_anti")
    counted = missing.agg(
        *[F.count_if(F.col("relation") == name).alias(f"k{i}") for i, name in enumerate(relations)],
        *[
            F.coalesce(F.sum(F.when(F.col("relation") == name, F.col("n"))), F.lit(0)).alias(f"r{i}")
            for i, name in enumerate(relations)
        ],
    )
    results = [
        F.struct(
            F.col(f"k{i}").alias("orphan_keys"),
            F.col(f"r{i}").alias("orphan_rows"),
            F.lit(name).alias("relation"),
        )
        for i, name in enumerate(relations)
    ]
    return counted.select(F.inline(F.array(*results)))
