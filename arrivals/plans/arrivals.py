"""Arrival records to the fact table of the star schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.functions import sas_date
from arrivals.operators import Codes, Dimension, dimensions, lookup
from arrivals.plans.mappings import BadCodeList
from arrivals.sinks import in_turns, publish, write_counted

# Defaults of the lookups, and each output column with the column it renames.
NO_MODE = "Not reported"
NO_STATE = "99"
NO_VISA = "Other"

OUTPUT = {
    "year": "i94yr",
    "month": "i94mon",
    "birth_country": "i94cit",
    "residence_country": "i94res",
    "port": "i94port",
    "arrival_date": "arrdate",
    "arrival_mode": "arrival_mode",
    "us_state": "us_state",
    "departure_date": "depdate",
    "repondent_age": "i94bir",
    "visa_type_code": "visa_type_code",
    "date_added": "dtadfile",
    "visa_issued_department": "visapost",
    "occupation": "occup",
    "arrival_flag": "entdepa",
    "departure_flag": "entdepd",
    "update_flag": "entdepu",
    "match_arrival_departure_fag": "matflag",
    "birth_year": "biryear",
    "allowed_date": "dtaddto",
    "ins_number": "insnum",
    "airline": "airline",
    "admission_number": "admnum",
    "flight_number": "fltno",
    "visa_type": "visatype",
}

# Directory columns of the two stored layouts.
STATE_LAYOUT = ["year", "month", "us_state"]
MODE_LAYOUT = ["year", "month", "arrival_mode", "port"]
LAYOUTS = {"_us_state": STATE_LAYOUT, "_arrival_mode": MODE_LAYOUT}
# Datasets that grow by months are named so; the first columns of the layouts that make a month.
MONTHS, MONTH_KEYS = "_months", 2

# Bytes of the files of facts that are stored in one turn of a layout: for each core, and at least.
TURN_BYTES, LEAST_TURN = 32 << 20, 256 << 20

# What a row is marked with, in one number, so that rows can be counted as they are stored.
MARKS = "__marks"
_NO_STATE, _NO_VISA, _NO_MODE, _DATED, _UNDATED, _FAULTY = (1 << i for i in range(6))


def metrics() -> dict[str, Column]:
    """Counts of the rows with each mark."""
    bits = {"no_state": _NO_STATE, "no_visa": _NO_VISA, "no_mode": _NO_MODE, "dated": _DATED, "undated": _UNDATED, "faulty": _FAULTY}
    return {name: F.count_if(F.col(MARKS).bitwiseAND(bit) != 0) for name, bit in bits.items()}


@dataclass(frozen=True)
class ArrivalDimensions:
    """The checked lookup tables of the fact table."""

    us_state: Dimension
    visa: Dimension
    mode: Dimension

    @classmethod
    def of(cls, us_state: DataFrame, visa: DataFrame, mode: DataFrame) -> ArrivalDimensions:
        """Measure and check the lists; one without codes would give every fact the default and is refused."""
        checked = dimensions(
            {
                "us_state": Codes(us_state, "state_code", "state_code"),
                "visa": Codes(visa, "visa_code", "visa", numeric=True),
                "mode": Codes(mode, "mode_code", "mode", numeric=True),
            }
        )
        if empty := [name for name, dim in checked.items() if not dim.rows]:
            raise BadCodeList(f"no codes in {empty}")
        return cls(**checked)


def conform_arrivals(facts: DataFrame, dims: ArrivalDimensions, departure_day: bool = False, marks: bool = False, faulty: str | None = None) -> DataFrame:
    """Decode the arrival date, resolve state, visa and mode, and name the columns.

    One output row for each fact row; with broadcast lookups one stage without a shuffle.
    `departure_date` stays a day number; `departure_day` adds it decoded as a last column. With `marks`, a last
    column MARKS tells which lookups missed, if the row should have and has a date, and if it is
    faulty, as the column `faulty` of the facts says; `metrics` counts them.
    """
    bits = []
    if marks:
        day = F.col("arrdate").try_cast("double")
        should = day.isNotNull() & (day != 0)
        bits = [(should, _DATED), (should & sas_date(day).isNull(), _UNDATED)]
        if faulty:
            bits.append((F.col(faulty), _FAULTY))
        facts = facts.withColumn(MARKS, _sum_of(bits))
    resolved = facts.withColumn("arrdate", sas_date(F.col("arrdate")))
    for dim, key, into, default, bit in (
        (dims.us_state, "i94addr", "us_state", NO_STATE, _NO_STATE),
        (dims.visa, "i94visa", "visa_type_code", NO_VISA, _NO_VISA),
        (dims.mode, "i94mode", "arrival_mode", NO_MODE, _NO_MODE),
    ):
        resolved = lookup(resolved, dim, key, into, default, "__missed" if marks else None)
        if marks:
            resolved = resolved.withColumn(MARKS, F.col(MARKS) + _sum_of([(F.col("__missed"), bit)])).drop("__missed")
    columns = [F.col(source).alias(name) for name, source in OUTPUT.items()]
    if departure_day:
        columns.append(sas_date(F.col("depdate")).alias("departure_day"))
    if marks:
        columns.append(F.col(MARKS))
    return resolved.select(columns)


def _sum_of(bits: list[tuple[Column, int]]) -> Column:
    return sum((F.when(holds, bit).otherwise(0) for holds, bit in bits), F.lit(0))


def store_arrivals(arrivals: DataFrame | list[DataFrame], path: str, replace: str = "all") -> dict[str, int]:
    """Store the fact table in both layouts; return the number of `rows`, and the `metrics` if it has MARKS.

    A list holds the fact table in parts, of which each is written in a turn of its own: of each layout the shuffle of one part lies on disk at a time.

    The second layout scans the source again. That costs one more pruned read and some broadcast
    probes, where keeping the whole fact table would fill the disks of the executors. All else is counted as
    the first layout is written. With replace="months" the months in `arrivals` are replaced whole in the
    dataset at `path` + MONTHS, both layouts at once (`arrivals.sinks.months`), and all others stay.
    """
    turns = arrivals if isinstance(arrivals, list) else [arrivals]
    marked = MARKS in turns[0].columns
    counts, hidden = (metrics(), [MARKS]) if marked else ({}, [])
    if replace == "months":
        return publish(turns, path + MONTHS, LAYOUTS, MONTH_KEYS, counts, hidden)
    # Side by side: what few files of one turn leave idle, the other layout uses.
    with ThreadPoolExecutor(2) as side_by_side:
        first = side_by_side.submit(in_turns, turns, lambda t, *how: write_counted(t, path + "_us_state", STATE_LAYOUT, counts, hidden, *how))
        second = side_by_side.submit(in_turns, [t.drop(*hidden) for t in turns], lambda t, *how: write_counted(t, path + "_arrival_mode", MODE_LAYOUT, None, None, *how))
    counted, again = first.result(), second.result()
    if counted["rows"] != again["rows"]:
        raise RuntimeError(f"the layouts hold {counted['rows']} and {again['rows']} rows: the source changed in between")
    return counted
