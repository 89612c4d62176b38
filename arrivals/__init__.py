"""Arrivals: a Spark library that turns travel-arrival records into a star schema."""
