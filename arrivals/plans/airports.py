"""Airport list to the table of airport codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.functions import nth_part
from arrivals.operators import union_codes
from arrivals.quality import count_distinct
from arrivals.schemas import AIRPORTS, check_schema
from arrivals.sinks import write_ranged

# The country kept, the code columns, the range keys, and the number of files.
COUNTRY_KEPT = "US"
CODE_COLUMNS = ["iata_code", "local_code"]
RANGE_KEYS = ["airport_code", "state"]
FILES = 3


def clean_airports(raw: DataFrame, swap_axes: bool = False) -> DataFrame:
    """Distinct airports of the country, one row for each of an airport's codes.

    The final distinct also removes repeated input rows, so there is one shuffle, not two. The
    first coordinate is the latitude unless `swap_axes` is set.
    """
    first, second = (nth_part(F.col("coordinates"), ",", i).try_cast("double") for i in (0, 1))
    split = raw.filter(F.col("iso_country") == COUNTRY_KEPT).withColumns(
        {
            "state": nth_part(F.col("iso_region"), "-", 1),
            "latitude": second if swap_axes else first,
            "longitude": first if swap_axes else second,
        }
    )
    shaped = split.drop("coordinates", "iso_region", "continent")
    return union_codes(shaped, CODE_COLUMNS, "airport_code").select(AIRPORTS.names)


def store_airports(raw: DataFrame, path: str, files: int = FILES) -> tuple[int, int]:
    """Store the cleaned airports in up to `files` files; return the distinct rows read and the rows stored."""
    airports = check_schema(clean_airports(raw), AIRPORTS)
    rows_in = count_distinct(raw)
    return rows_in, write_ranged(airports, path, RANGE_KEYS, files)
