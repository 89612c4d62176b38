from helpers import parquet_files, planned, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrivals.operators import distinct_rows, union_codes
from arrivals.plans import clean_airports, store_airports
from arrivals.schemas import AIRPORTS, AIRPORTS_RAW, check_schema
from arrivals.sources import read_airports, read_stored

BASE = {
    "airport_id": "X1",
    "type": "small_airport",
    "name": "Field",
    "elevation_ft": "12",
    "continent": "NA",
    "iso_country": "US",
    "iso_region": "US-KS",
    "municipality": "Town",
    "gps_code": "KX1",
    "iata_code": None,
    "local_code": None,
    "coordinates": "1.5, -2.5",
}


def airports(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], AIRPORTS_RAW)


def codes(df):
    return rows(df.select("airport_id", "airport_code"))


def test_codes(spark):
    raw = airports(
        spark,
        {"airport_id": "two", "iata_code": "AAA", "local_code": "BBB"},
        {"airport_id": "equal", "iata_code": "CCC", "local_code": "CCC"},
        {"airport_id": "iata", "iata_code": "DDD"},
        {"airport_id": "local", "local_code": "EEE"},
        {"airport_id": "neither"},
    )
    expected = [("equal", "CCC"), ("iata", "DDD"), ("local", "EEE"), ("two", "AAA"), ("two", "BBB")]
    assert codes(clean_airports(raw)) == expected


def test_other_countries_and_repeated_rows_are_removed(spark):
    row = {"iata_code": "AAA"}
    raw = airports(spark, row, row, row, {**row, "iso_country": "CA"}, {**row, "iso_country": None})
    assert codes(clean_airports(raw)) == [("X1", "AAA")]


def test_rows_that_differ_only_in_a_dropped_column_merge(spark):
    raw = airports(spark, {"iata_code": "AAA", "continent": "NA"}, {"iata_code": "AAA", "continent": "SA"})
    assert distinct_rows(raw).count() == 2
    assert codes(clean_airports(raw)) == [("X1", "AAA")]


def test_region_and_coordinates(spark):
    def cleaned(**change):
        [row] = clean_airports(airports(spark, {"iata_code": "AAA", **change})).collect()
        return row["state"], row["latitude"], row["longitude"]

    assert cleaned() == ("KS", 1.5, -2.5)
    assert cleaned(iso_region="US") == (None, 1.5, -2.5)
    assert cleaned(iso_region="US-A-B") == ("A", 1.5, -2.5)
    assert cleaned(iso_region=None) == (None, 1.5, -2.5)
    assert cleaned(coordinates="bad") == ("KS", None, None)
    assert cleaned(coordinates="1,") == ("KS", 1.0, None)
    assert cleaned(coordinates=None) == ("KS", None, None)
    assert cleaned(coordinates="1,2,3") == ("KS", 1.0, 2.0)


def test_axes_can_be_swapped(spark):
    raw = airports(spark, {"iata_code": "AAA"})
    [row] = clean_airports(raw, swap_axes=True).collect()
    assert (row["latitude"], row["longitude"]) == (-2.5, 1.5)
    check_schema(clean_airports(raw), AIRPORTS)


def test_one_scan_and_one_shuffle(spark):
    plan = planned(clean_airports(airports(spark, {"iata_code": "AAA"})))
    assert plan.count("Exchange") == 1


def test_country_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "airports.csv")
    airports(spark, {"iata_code": "AAA"}).write.csv(path, header=True)
    raw = read_airports(spark, path)
    for source in (raw, distinct_rows(raw)):
        assert "PushedFilters: [IsNotNull(iso_country), EqualTo(iso_country,US)]" in planned(clean_airports(source))


def test_store(spark, tmp_path):
    source, target = str(tmp_path / "airports.csv"), str(tmp_path / "stored")
    changes = [{"airport_id": f"X{i}", "iata_code": f"I{i:03}", "local_code": f"L{i:03}"} for i in range(40)]
    airports(spark, *changes, changes[0], {"iso_country": "CA"}).write.csv(source, header=True)
    raw = read_airports(spark, source)
    assert store_airports(raw, target) == (41, 80)
    assert len(parquet_files(target)) == 3
    assert rows(read_stored(spark, target, AIRPORTS)) == rows(clean_airports(raw))


def test_the_number_of_files_is_an_argument(spark, tmp_path):
    raw = airports(spark, *[{"iata_code": f"I{i:03}"} for i in range(40)])
    store_airports(raw, str(tmp_path / "stored"), files=8)
    assert len(parquet_files(tmp_path / "stored")) == 8


CODE = st.sampled_from(["A", "B", "C"]) | st.none()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xy"), CODE, CODE), max_size=12))
def test_union_codes_is_the_distinct_union(spark, data):
    df = spark.createDataFrame(data, "id string, c1 string, c2 string")
    expected = {(i, c) for i, c1, c2 in data for c in (c1, c2) if c is not None}
    by_sql = (
        df.where("c1 is not null").select("id", F.col("c1").alias("code"))
        .union(df.where("c2 is not null").select("id", F.col("c2").alias("code")))
        .distinct()
    )
    found = rows(union_codes(df, ["c1", "c2"], "code"))
    assert found == sorted(expected) == rows(by_sql)
