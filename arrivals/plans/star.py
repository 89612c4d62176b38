"""The whole star schema: code lists, airports, demographics, arrivals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arrivals.operators import COUNTRY, MODE, US_PORT, US_STATE, VISA
from arrivals.plans.airports import FILES, store_airports
from arrivals.plans.arrivals import LAYOUTS, LEAST_TURN, MARKS, MONTHS, TURN_BYTES, ArrivalDimensions, conform_arrivals, store_arrivals
from arrivals.plans.demographics import store_demographics
from arrivals.plans.mappings import load_mapping
from arrivals.quality import count_rows, preview, report
from arrivals.schemas import AIRPORTS, AIRPORTS_RAW, ARRIVALS, COUNTRIES, DEMOGRAPHICS, US_PORTS, US_STATES, check_schema
from arrivals.sinks import read_published, write_plain
from arrivals.sources import (
    by_files,
    count_lines,
    faulty_lines,
    read_airports,
    read_demographics,
    read_facts,
    read_facts_untyped,
    read_mapping_lines,
    read_stored,
)

# Names of the stored datasets. The arrivals get one suffix for each layout.
COUNTRIES_NAME = "countries"
STATES_NAME = "us_states"
PORTS_NAME = "us_ports"
AIRPORTS_NAME = "us_airports"
DEMOGRAPHICS_NAME = "us_cities_demographics"
ARRIVALS_NAME = "immigration_data"
_FAULTY = "__faulty"


@dataclass(frozen=True)
class StarInputs:
    """Where the inputs lie: paths or URIs of any file system Spark can reach."""

    countries: str
    us_states: str
    us_ports: str
    visas: str
    modes: str
    airports: str
    demographics: str
    facts: str
    facts_format: str = "parquet"


def load_star(
    spark: SparkSession,
    inputs: StarInputs,
    output: str,
    replace_arrivals: str = "all",
    airport_files: int = FILES,
    preview_rows: int = 0,
    turn_bytes: int | None = None,
) -> DataFrame:
    """Store every dataset below `output`, replacing earlier ones.

    With `replace_arrivals="months"` the months of the facts are replaced whole and arrivals of other
    months stay, so that months can be added to one dataset, and delivered again; it is read with
    `read_arrivals`. The airports go into up to `airport_files` files. With `preview_rows`, so many first rows
    of each stored dataset are shown.

    The facts are stored in turns, by whole files of up to `turn_bytes` together (by default TURN_BYTES for
    each core), so that a layout's shuffle of one turn lies on disk at a time. A turn adds its own files to each directory.

    CSV records with a bad value or a wrong number of fields are kept, with nulls, and stored as they
    stand below `output`/rejected.

    Returns a report with the rows read and stored of each dataset, and of each check the rows that it
    looked at and those that passed. Visa and mode lists only serve the lookups and are not stored.
    """
    root = output.rstrip("/") + "/"
    states = load_mapping(spark, inputs.us_states, US_STATE)
    counts = []
    for name, path, table, schema in (
        (COUNTRIES_NAME, inputs.countries, load_mapping(spark, inputs.countries, COUNTRY), COUNTRIES),
        (STATES_NAME, inputs.us_states, states, US_STATES),
        (PORTS_NAME, inputs.us_ports, load_mapping(spark, inputs.us_ports, US_PORT), US_PORTS),
    ):
        lines = count_rows(read_mapping_lines(spark, path)).first()["rows"]
        counts.append((name, lines, write_plain(check_schema(table, schema), root + name)))

    for name, path, schema, separator in (
        (AIRPORTS_NAME, inputs.airports, AIRPORTS_RAW, ","),
        (DEMOGRAPHICS_NAME, inputs.demographics, DEMOGRAPHICS, ";"),
    ):
        lines, faulty = count_lines(spark, path, schema, separator)
        if faulty:
            write_plain(faulty_lines(spark, path, schema, separator), f"{root}rejected/{name}")
        counts.append((f"{name} lines", lines, lines - faulty))
    counts.append((AIRPORTS_NAME, *store_airports(read_airports(spark, inputs.airports), root + AIRPORTS_NAME, airport_files)))
    demographics = read_demographics(spark, inputs.demographics)
    counts.append((DEMOGRAPHICS_NAME, *store_demographics(demographics, root + DEMOGRAPHICS_NAME)))

    dims = ArrivalDimensions.of(
        us_state=states,
        visa=load_mapping(spark, inputs.visas, VISA),
        mode=load_mapping(spark, inputs.modes, MODE),
    )
    if inputs.facts_format == "csv":
        facts = read_facts_untyped(spark, inputs.facts, faulty=_FAULTY)
    else:
        facts = read_facts(spark, inputs.facts, inputs.facts_format, faulty=_FAULTY)
    turn_bytes = turn_bytes or max(LEAST_TURN, spark.sparkContext.defaultParallelism * TURN_BYTES)
    arrivals = [conform_arrivals(turn, dims, marks=True, faulty=_FAULTY) for turn in by_files(facts, inputs.facts, turn_bytes)]
    check_schema(arrivals[0].drop(MARKS), ARRIVALS)
    found = store_arrivals(arrivals, root + ARRIVALS_NAME, replace_arrivals)
    rows = found["rows"]
    # Files with row counts tell how many rows they have. Others are not read again for that; lookups keep every row.
    rows_in = rows if inputs.facts_format == "csv" else count_rows(facts).first()["rows"]
    if rows_in != rows:
        raise RuntimeError(f"{rows_in} facts were read and {rows} stored")
    if found["faulty"]:
        write_plain(facts.filter(_FAULTY).drop(_FAULTY), f"{root}rejected/{ARRIVALS_NAME}")
    counts += [
        (ARRIVALS_NAME, rows_in, rows),
        ("typed facts", rows, rows - found["faulty"]),
        ("arrival dates", found["dated"], found["dated"] - found["undated"]),
        *((f"{name} lookups", rows, rows - found[f"no_{name}"]) for name in ("state", "visa", "mode")),
    ]
    for name, path, dim in (("visas", inputs.visas, dims.visa), ("modes", inputs.modes, dims.mode)):
        counts.append((name, count_rows(read_mapping_lines(spark, path)).first()["rows"], dim.rows))
    if preview_rows:
        _show(spark, root, replace_arrivals, preview_rows)
    return report(spark, counts)


def read_arrivals(spark: SparkSession, output: str, layout: str = "_us_state") -> DataFrame:
    """The arrivals of all months that `load_star` stored with replace_arrivals="months"."""
    return read_published(spark, f"{output.rstrip('/')}/{ARRIVALS_NAME}{MONTHS}", layout, ARRIVALS)


def _show(spark: SparkSession, root: str, replace_arrivals: str, rows: int) -> None:
    """Print the first rows of each stored dataset, in the order of its first columns."""
    for name, schema in (
        (COUNTRIES_NAME, COUNTRIES),
        (STATES_NAME, US_STATES),
        (PORTS_NAME, US_PORTS),
        (AIRPORTS_NAME, AIRPORTS),
        (DEMOGRAPHICS_NAME, DEMOGRAPHICS),
        *((ARRIVALS_NAME + layout, ARRIVALS) for layout in LAYOUTS),
    ):
        if name.startswith(ARRIVALS_NAME) and replace_arrivals == "months":
            stored = read_arrivals(spark, root, name.removeprefix(ARRIVALS_NAME))
        else:
            stored = read_stored(spark, root + name, schema)
        print(name)
        preview(stored, schema.names, rows).show(rows, truncate=False)
