"""Readers. Each one returns a lazy DataFrame with a declared schema."""

from arrivals.sources.delimited import check_header, count_lines, faulty_lines, read_airports, read_delimited, read_demographics
from arrivals.sources.facts import by_files, read_facts, read_facts_untyped
from arrivals.sources.mapping_text import read_mapping_lines, split_mapping_lines, unpaired_lines
from arrivals.sources.stored import read_stored

__all__ = [
    "by_files",
    "check_header",
    "count_lines",
    "faulty_lines",
    "read_airports",
    "read_delimited",
    "read_demographics",
    "read_facts",
    "read_facts_untyped",
    "read_mapping_lines",
    "read_stored",
    "split_mapping_lines",
    "unpaired_lines",
]
