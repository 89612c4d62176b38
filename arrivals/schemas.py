"""Declared schemas of every input and output. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(text: str) -> StructType:
    """Build a schema from `name type` lines, all columns nullable."""
    kinds = {
        "string": StringType(),
        "double": DoubleType(),
        "int": IntegerType(),
        "bigint": LongType(),
    }
    pairs = (line.split() for line in text.strip().splitlines())
    return StructType([StructField(name, kinds[kind]) for name, kind in pairs])


# Column names and types of the inputs and outputs.
FACTS = _struct("""
    i94yr double
    i94mon double
    i94cit double
    i94res double
    i94port string
    arrdate double
    i94mode double
    i94addr string
    depdate double
    i94bir double
    i94visa double
    dtadfile string
    visapost string
    occup string
    entdepa string
    entdepd string
    entdepu string
    matflag string
    biryear double
    dtaddto string
    insnum string
    airline string
    admnum double
    fltno string
    visatype string
""")

AIRPORTS_RAW = _struct("""
    airport_id string
    type string
    name string
    elevation_ft string
    continent string
    iso_country string
    iso_region string
    municipality string
    gps_code string
    iata_code string
    local_code string
    coordinates string
""")

AIRPORTS = _struct("""
    airport_id string
    type string
    name string
    elevation_ft string
    iso_country string
    state string
    municipality string
    gps_code string
    airport_code string
    latitude double
    longitude double
""")

DEMOGRAPHICS = _struct("""
    city string
    state string
    median_age double
    male_population string
    female_population string
    total_population int
    number_of_veterans int
    number_of_foreign_born int
    average_household_size double
    state_code string
    race string
    count int
""")

COUNTRIES = _struct("""
    country_code bigint
    country string
""")

US_STATES = _struct("""
    state_code string
    state string
""")

US_PORTS = _struct("""
    port_code string
    city string
    state string
""")

VISAS = _struct("""
    visa_code bigint
    visa string
""")

MODES = _struct("""
    mode_code bigint
    mode string
""")

ARRIVALS = _struct("""
    year double
    month double
    birth_country double
    residence_country double
    port string
    arrival_date string
    arrival_mode string
    us_state string
    departure_date double
    repondent_age double
    visa_type_code string
    date_added string
    visa_issued_department string
    occupation string
    arrival_flag string
    departure_flag string
    update_flag string
    match_arrival_departure_fag string
    birth_year double
    allowed_date string
    ins_number string
    airline string
    admission_number double
    flight_number string
    visa_type string
""")


class SchemaMismatch(ValueError):
    """A DataFrame does not have the declared columns."""


def check_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Return `df` unchanged, or fail if names, order or types differ from `expected`."""
    found = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in expected]
    if found != wanted:
        missing = [f"{n} {t.simpleString()}" for n, t in wanted if (n, t) not in found]
        surplus = [f"{n} {t.simpleString()}" for n, t in found if (n, t) not in wanted]
        raise SchemaMismatch(f"missing {missing}, unexpected {surplus}, or a different order")
    return df


def check_columns(df: DataFrame, expected: StructType, types: bool = True) -> DataFrame:
    """Return `df` unchanged, or fail if it lacks a column of `expected` or has it with another type."""
    found = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in expected if f.name not in found]
    unlike = [f"{f.name} {found[f.name].simpleString()}" for f in expected if types and f.name in found and found[f.name] != f.dataType]
    if missing or unlike:
        raise SchemaMismatch(f"missing {missing}, unlike {unlike}")
    return df
