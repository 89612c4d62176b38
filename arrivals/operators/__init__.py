"""DataFrame operators."""

from arrivals.operators.codes import union_codes
from arrivals.operators.dedup import dedup, distinct_rows
from arrivals.operators.lookup import Codes, Dimension, DuplicateKey, dimension, dimensions, lookup
from arrivals.operators.mapping import (
    COUNTRY,
    MODE,
    US_PORT,
    US_STATE,
    VISA,
    MappingSpec,
    clean_mapping,
)

__all__ = [
    "COUNTRY",
    "MODE",
    "US_PORT",
    "US_STATE",
    "VISA",
    "Codes",
    "Dimension",
    "DuplicateKey",
    "MappingSpec",
    "clean_mapping",
    "dedup",
    "dimension",
    "dimensions",
    "distinct_rows",
    "lookup",
    "union_codes",
]
