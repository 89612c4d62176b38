from dataclasses import replace

import pytest
from helpers import rows

from arrivals.operators import COUNTRY, MODE, US_PORT, US_STATE, VISA, clean_mapping
from arrivals.plans import load_mapping
from arrivals.schemas import COUNTRIES, MODES, US_PORTS, US_STATES, VISAS, check_schema


def cleaned(spark, spec, *lines):
    return rows(clean_mapping(spark.createDataFrame([(line,) for line in lines], "value string"), spec))


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("   41 =  'FREEDONIA'", (41, "FREEDONIA")),
        ("    0  =  'INVALID: NOWHERE'", (0, "Other")),
        ("   42 =  'X INVALID Y'", (42, "X Other")),
        ("   43 =  'SYLDAVIA '", (43, "SYLDAVIA ")),
        ("   44 =  'No Country Code (7)'", (44, "Other")),
        ("   45 =  'Collapsed Z (note)'  ", (45, "Other")),
        ("   46 =  'A =  B'", (46, "A =  B")),
        ("   x =  'NOT A NUMBER'", (None, "NOT A NUMBER")),
        ("   47 =  UNQUOTED (a, b)", (47, "UNQUOTED (a, b)")),
    ],
)
def test_country(spark, line, expected):
    assert cleaned(spark, COUNTRY, line) == [expected]


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("\t'QQ'='QUUX' ", ("QQ", "QUUX ")),
        ("  'QR'='QUUX'", ("QR", "QUUX")),
        ("'QS'= 'QUUX'", ("QS", "QUUX")),
        ("'QT\t'='QUUX\t'", ("QT", "QUUX\t")),
        ("'QU '='QUUX'", ("QU ", "QUUX")),
    ],
)
def test_state(spark, line, expected):
    assert cleaned(spark, US_STATE, line) == [expected]


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("   'ABC'\t=\t'TOWN, ZZ      '", ("ABC", "TOWN", "ZZ")),
        ("   'ABD'\t=\t'TOWN, PIER 9, ZZ'", ("ABD", "TOWN", "PIER 9, ZZ")),
        ("   'ABE'\t=\t'TOWN,ZZ   '", ("ABE", "TOWN,ZZ   ", None)),
        ("   'ABF'\t=\t'ST''A, ZZ'", ("ABF", "STA", "ZZ")),
        ("   'ABG'\t=\t'No PORT Code (Q)'", ("ABG", "No PORT Code (Q)", None)),
        ("   'ABH'\t=\t'TOWN , ZZ (BPS)'", ("ABH", "TOWN ", "ZZ (BPS)")),
        ("   'AB'\t\t=\t'TOWN, ZZ'", ("AB\t", "TOWN", "ZZ")),
        ("   'AC' \t=\t'TOWN, ZZ'", ("AC ", "TOWN", "ZZ")),
        ("   '060'\t=\t'TOWN, ZZ'", ("060", "TOWN", "ZZ")),
    ],
)
def test_port(spark, line, expected):
    assert cleaned(spark, US_PORT, line) == [expected]


def test_port_codes_are_trimmed_on_request(spark):
    spec = replace(US_PORT, trim_codes=True)
    lines = ["   'AB'\t\t=\t'TOWN, ZZ'", "   'AC' \t=\t'TOWN, ZZ'"]
    assert cleaned(spark, spec, *lines) == [("AB", "TOWN", "ZZ"), ("AC", "TOWN", "ZZ")]


def test_lines_without_a_pair_are_dropped(spark):
    assert cleaned(spark, US_PORT, ";", "", "   ", "   'A'\t=\t'B, C'") == [("A", "B", "C")]


def test_visa_and_mode(spark):
    assert cleaned(spark, VISA, "   1 = Work", "   2 = Fun ") == [(1, "Work"), (2, "Fun")]
    assert cleaned(spark, MODE, "\t1 = 'Foot'", "\t9 = 'Not reported'") == [(1, "Foot"), (9, "Not reported")]


@pytest.mark.parametrize(
    ("spec", "schema"),
    [(COUNTRY, COUNTRIES), (US_STATE, US_STATES), (US_PORT, US_PORTS), (VISA, VISAS), (MODE, MODES)],
)
def test_declared_schemas(spark, spec, schema):
    check_schema(clean_mapping(spark.createDataFrame([], "value string"), spec), schema)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_load_from_file(spark, tmp_path, end):
    path = tmp_path / "ports.txt"
    path.write_bytes(end.join(["   'AAA'\t=\t'ONE, AA  '", "   'BBB'\t=\t'TWO'", ";", ""]).encode())
    assert rows(load_mapping(spark, str(path), US_PORT)) == [("AAA", "ONE", "AA"), ("BBB", "TWO", None)]
