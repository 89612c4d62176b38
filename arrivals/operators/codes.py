"""Union of several code columns of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_codes(df: DataFrame, columns: list[str], into: str) -> DataFrame:
    """Distinct rows of `df` with `columns` replaced by `into`, one row for each code.

    Equal to the distinct union of one selection per code column, but the input is scanned
    once. A row without any code disappears. Column `into` stands where the first one stood.
    """
    code = F.explode(F.array_compact(F.array_distinct(F.array(*[F.col(c) for c in columns]))))
    kept = [c for c in df.columns if c not in columns[1:]]
    return (
        df.withColumn(into, code)
        .select([F.col(into) if c == columns[0] else F.col(c) for c in kept])
        .distinct()
    )
