"""Removal of duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Copies collapse before the shuffle."""
    return df.distinct()


def dedup(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row for each combination of `keys` (null counts as a value), columns unchanged.

    The survivor is the least row by `order`, then by all other columns, nulls first, so the
    result does not depend on how the input is partitioned. As a minimum it is aggregated
    before the shuffle: a hot key sends one row per task, where a window would gather them all.
    """
    order = order or []
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.distinct()
    least = F.min(F.struct(*[F.col(c) for c in rest])).alias("__least")
    kept = df.groupBy(*keys).agg(least)
    return kept.select([F.col(c) if c in keys else F.col("__least")[c].alias(c) for c in df.columns])
