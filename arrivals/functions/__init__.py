"""Column functions; all of them are compositions of Spark built-ins."""

from arrivals.functions.dates import sas_date
from arrivals.functions.text import nth_part, relabel, remove_chars, trim_blank_edges, trim_leading_spaces

__all__ = [
    "nth_part",
    "relabel",
    "remove_chars",
    "sas_date",
    "trim_blank_edges",
    "trim_leading_spaces",
]
