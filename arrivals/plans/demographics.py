"""City demographics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.operators import dedup
from arrivals.quality import count_rows
from arrivals.schemas import DEMOGRAPHICS, check_schema
from arrivals.sinks import write_partitioned

# The key of a record, and the directory column.
KEYS = ["state", "city", "race"]
LAYOUT = ["state"]


def clean_demographics(raw: DataFrame) -> DataFrame:
    """Records with a state, one for each state, city and race."""
    return dedup(raw.filter(F.col("state").isNotNull()), KEYS)


def store_demographics(raw: DataFrame, path: str) -> tuple[int, int]:
    """Store the cleaned records; return the rows read and the rows stored."""
    records = check_schema(clean_demographics(raw), DEMOGRAPHICS)
    rows_in = count_rows(raw).first()["rows"]
    return rows_in, write_partitioned(records, path, LAYOUT)
