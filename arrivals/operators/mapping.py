"""Cleaning of code lists into dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.functions import nth_part, relabel, remove_chars, trim_blank_edges
from arrivals.sources import split_mapping_lines


@dataclass(frozen=True)
class MappingSpec:
    """What one code list looks like and how its columns are cleaned."""

    code: str
    label: str
    separator: str
    numeric_code: bool = False
    # Characters deleted from text codes. Other blanks stay unless trim_codes is set.
    strip_from_code: str = ""
    trim_codes: bool = False
    # Labels, or the ends of labels, matching one of these become `other`.
    invalid_labels: tuple[str, ...] = ()
    other: str = "Other"
    # Name of a column for what follows the first ", " of the label.
    split_into: str | None = None


# Separators, column names, and label patterns of the five code lists.
COUNTRY = MappingSpec(
    code="country_code",
    label="country",
    separator=" =  ",
    numeric_code=True,
    invalid_labels=("No Country.*", "INVALID.*", "Collapsed.*"),
)
US_STATE = MappingSpec(code="state_code", label="state", separator="=", strip_from_code="'\t")
US_PORT = MappingSpec(code="port_code", label="city", separator="\t=\t", strip_from_code="'", split_into="state")
VISA = MappingSpec(code="visa_code", label="visa", separator=" = ", numeric_code=True)
MODE = MappingSpec(code="mode_code", label="mode", separator=" = ", numeric_code=True)


def clean_mapping(lines: DataFrame, spec: MappingSpec) -> DataFrame:
    """Turn the text lines (`value`) of a code list into a dimension table.

    One narrow projection: no shuffle and nothing on the driver.
    """
    pairs = split_mapping_lines(lines, spec.separator)

    code = F.col("code")
    if spec.numeric_code:
        code = code.try_cast("bigint")
    else:
        code = remove_chars(code, spec.strip_from_code) if spec.strip_from_code else code
        code = trim_blank_edges(code) if spec.trim_codes else code

    label = remove_chars(F.col("label"), "'")
    if spec.invalid_labels:
        label = relabel(label, spec.invalid_labels, spec.other)

    if spec.split_into is None:
        return pairs.select(code.alias(spec.code), label.alias(spec.label))
    # The first part keeps its blanks, the second is trimmed.
    return pairs.select(
        code.alias(spec.code),
        nth_part(label, ", ", 0, limit=2).alias(spec.label),
        F.trim(nth_part(label, ", ", 1, limit=2)).alias(spec.split_into),
    )
