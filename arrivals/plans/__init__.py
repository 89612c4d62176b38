"""Whole loads, composed of sources, operators and sinks."""

from arrivals.plans.airports import clean_airports, store_airports
from arrivals.plans.arrivals import ArrivalDimensions, conform_arrivals, store_arrivals
from arrivals.plans.demographics import clean_demographics, store_demographics
from arrivals.plans.mappings import load_mapping
from arrivals.plans.star import StarInputs, load_star, read_arrivals

__all__ = [
    "ArrivalDimensions",
    "StarInputs",
    "clean_airports",
    "clean_demographics",
    "conform_arrivals",
    "load_mapping",
    "load_star",
    "read_arrivals",
    "store_airports",
    "store_arrivals",
    "store_demographics",
]
