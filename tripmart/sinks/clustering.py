"""A space-filling-curve key over several columns, so that a filter on any of them skips files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows whose values place the cuts. Only where rows lie depends on them, never which rows there are.
SAMPLE_ROWS = 10_000

# A rank has so many bits: 2^bits slices of a column.
RANK_BITS = 8
KEY_BITS = 62


def _cuts(values: list, slices: int) -> list:
    """Values that part the sample into ``slices`` of equal size; equal ones are one cut."""
    known = sorted(v for v in values if v is not None and v == v)
    if not known:
        return []
    at = [known[len(known) * i // slices] for i in range(1, slices)]
    return sorted(set(at) - {known[0]})


def _rank(name: str, cuts: list, kind: str, bits: int) -> Column:
    """How many cuts a value has reached, found by halving; NULL has reached none."""
    if not cuts:
        return F.lit(0)
    value = F.col(name)
    listed = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def step(rank: Column, width: Column) -> Column:
        reached = F.get(listed, rank + width - 1) <= value
        return F.when(F.coalesce(reached, F.lit(False)), rank + width).otherwise(rank)

    return F.aggregate(steps, F.lit(0), step)


def curve_key(df: DataFrame, columns: Sequence[str], sample_rows: int = SAMPLE_ROWS) -> Column:
    """The place of a row on a Z-order curve over the quantile ranks of ``columns``.

    Ranks follow a uniform sample of at most ``sample_rows`` rows (each task sends that many at
    most, and that many reach the driver), so skewed columns are cut as evenly as they allow. The
    key interleaves the ranks' bits, the first column's first.
    """
    bits = min(RANK_BITS, KEY_BITS // len(columns))
    sample = (
        df.select(*columns, F.rand(7).alias("_order")).orderBy("_order").limit(sample_rows).select(*columns).collect()
    )
    kinds = dict(df.dtypes)
    key = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        cuts = _cuts([row[i] for row in sample], 1 << bits)
        rank = _rank(name, cuts, kinds[name], math.ceil(math.log2(len(cuts) + 1)) if cuts else 0).cast("long")
        # a column with fewer slices spreads over the high bits all the same
        rank = F.shiftleft(rank, bits - math.ceil(math.log2(len(cuts) + 1))) if cuts else rank
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return key
