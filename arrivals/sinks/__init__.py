"""Parquet writers for any file system Spark can reach."""

from arrivals.sinks.months import publications, publish, published, read_published, remove_replaced
from arrivals.sinks.parquet import in_turns, write_counted, write_partitioned, write_plain, write_ranged

__all__ = [
    "in_turns",
    "publications",
    "publish",
    "published",
    "read_published",
    "remove_replaced",
    "write_counted",
    "write_partitioned",
    "write_plain",
    "write_ranged",
]
