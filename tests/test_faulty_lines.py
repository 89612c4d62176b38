"""Headers and faulty records of CSV files, metrics of the load, previews, and the range layout."""

from dataclasses import replace

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_star import facts, inputs

from arrivals.plans import load_star, store_airports
from arrivals.quality import count_distinct
from arrivals.schemas import AIRPORTS, AIRPORTS_RAW, DEMOGRAPHICS, FACTS, SchemaMismatch
from arrivals.sources import check_header, count_lines, faulty_lines, read_airports, read_demographics, read_facts, read_facts_untyped, read_stored

HEADER = "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count"
GOOD = "Ury;Kansas;33.5;10;11;21;1;2;2.5;KS;Red;7"
BAD = ["Ury;Kansas;x;10;11;21;1;2;2.5;KS;Red;7", "Ury;Kansas;33.5;10;11;2.1;1;2;2.5;KS;Red;7", "Ury;Kansas;33.5;10", GOOD + ";8"]


def test_faulty_records_are_found_and_good_ones_unchanged(spark, tmp_path):
    path = tmp_path / "cities"
    path.mkdir()
    (path / "a.csv").write_text("\n".join([HEADER, GOOD, *BAD[:2]]) + "\n")
    (path / "b.csv").write_text("\n".join([HEADER, *BAD[2:], GOOD.replace("Kansas", "")]) + "\n")
    found = faulty_lines(spark, str(path), DEMOGRAPHICS, ";").collect()
    assert sorted(r["line"] for r in found) == sorted(BAD)
    by_line = {r["line"]: r for r in found}
    assert by_line[BAD[0]]["empty_columns"] == "median_age" and by_line[BAD[1]]["empty_columns"] == "total_population"
    assert by_line[BAD[2]]["file"].endswith("b.csv") and by_line[BAD[2]]["empty_columns"].startswith("female_population,")
    assert by_line[BAD[3]]["empty_columns"] == ""
    assert count_lines(spark, str(path), DEMOGRAPHICS, ";") == (6, 4)
    read = read_demographics(spark, str(path))
    assert read.columns == DEMOGRAPHICS.names and read.count() == 6
    whole = ("Ury", "Kansas", 33.5, "10", "11", 21, 1, 2, 2.5, "KS", "Red", 7)
    assert rows(read).count(whole) == 2


def test_headers_are_compared(spark, tmp_path):
    check_header(HEADER.split(";"), DEMOGRAPHICS, "")
    swapped = HEADER.replace("City;State;", "State;City;")
    path = tmp_path / "swapped.csv"
    path.write_text(f"{swapped}\n{GOOD}\n")
    with pytest.raises(SchemaMismatch, match="State"):
        read_demographics(spark, str(path))
    path = tmp_path / "short.csv"
    path.write_text("ident,type\n1,2\n")
    with pytest.raises(SchemaMismatch, match="2 columns for 12"):
        read_airports(spark, str(path))
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{HEADER}\n{GOOD}\n")
    (folder / "b.csv").write_text(f"{HEADER.replace('Race', 'Kind')}\n{GOOD}\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_demographics(spark, str(folder)).collect()
    (tmp_path / "empty.csv").write_text("")
    assert read_demographics(spark, str(tmp_path / "empty.csv")).collect() == []


def test_typed_facts_as_csv(spark, tmp_path):
    path = str(tmp_path / "facts.csv")
    facts(spark, {}).write.csv(path, header=True)
    (tmp_path / "facts.csv" / "more.csv").write_text(",".join(FACTS.names) + "\n" + ",".join(["x"] * 25) + "\n")
    assert rows(read_facts(spark, path, "csv", faulty="bad").select("i94yr", "bad")) == [(None, True), (2016.0, False)]
    names = [*FACTS.names[1::-1], *FACTS.names[2:]]
    (tmp_path / "swapped.csv").write_text(",".join(names) + "\n")
    with pytest.raises(SchemaMismatch):
        read_facts(spark, str(tmp_path / "swapped.csv"), "csv")


def test_load_reports_and_keeps_faulty_records(spark, tmp_path, capsys):
    source = inputs(spark, tmp_path / "in")
    cities, target = tmp_path / "cities.csv", str(tmp_path / "out")
    cities.write_text("\n".join(["a;b;c;d;e;f;g;h;i;j;k;l", GOOD, *BAD]) + "\n")
    raw = facts(spark, {}, {"i94visa": 9.0, "i94mode": None}, {"arrdate": 9e9}).withColumn("i94bir", F.col("i94bir").cast("string"))
    facts_csv = str(tmp_path / "facts.csv")
    raw.unionByName(facts(spark, {}).withColumn("i94bir", F.lit("old"))).write.csv(facts_csv, header=True)
    found = {r[0]: r[1:] for r in load_star(spark, replace(source, demographics=str(cities), facts=facts_csv, facts_format="csv"), target, preview_rows=1).collect()}
    assert found["us_cities_demographics lines"] == (5, 1) and found["us_airports lines"] == (3, 3)
    assert found["immigration_data"] == (4, 4) and found["typed facts"] == (4, 3)
    assert found["state lookups"] == (4, 4) and found["visa lookups"] == (4, 3) and found["mode lookups"] == (4, 3)
    assert found["arrival dates"] == (4, 3)
    assert sorted(r["line"] for r in spark.read.parquet(f"{target}/rejected/us_cities_demographics").collect()) == sorted(BAD)
    assert spark.read.parquet(f"{target}/rejected/immigration_data").count() == 1
    shown = capsys.readouterr().out
    assert all(name in shown for name in ("countries", "us_airports", "immigration_data_us_state", "immigration_data_arrival_mode", "only showing") [:4])
    assert shown.count("|2016.0|") == 2 and "FREEDONIA" not in shown


def test_facts_are_scanned_once_a_layout(spark, tmp_path):
    """Files are read for each layout; the number of rows in is taken from their footers."""
    source = inputs(spark, tmp_path / "in")
    read, calls = read_facts_untyped, []
    csv = str(tmp_path / "facts.csv")
    facts(spark, *[{"admnum": float(i)} for i in range(50)]).write.csv(csv, header=True)
    scanned = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        scanned.add(1)
        return x

    from arrivals.plans import star

    def counted(*args, **kw):
        calls.append(args)
        return read(*args, **kw).withColumn("admnum", seen.asNondeterministic()("admnum"))

    star.read_facts_untyped, kept = counted, star.read_facts_untyped
    try:
        load_star(spark, replace(source, facts=csv, facts_format="csv"), str(tmp_path / "out"))
    finally:
        star.read_facts_untyped = kept
    assert len(calls) == 1 and scanned.value == 2 * 50


def test_distinct_rows_are_counted_by_digest(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("", "a"), ("a,", "b"), ("a", ",b"), (None, None), ("-", None)], "x string, y string")
    assert count_distinct(df) == df.distinct().count() == 7


def test_a_lookup_in_the_range_layout_reads_few_rows(spark, tmp_path):
    path = str(tmp_path / "airports")
    n = 3000
    columns = {name: F.concat(F.lit(name[0]), F.col("id")) for name in AIRPORTS_RAW.names}
    columns |= {"iso_country": F.lit("US"), "iso_region": F.lit("US-KS"), "coordinates": F.lit("1, 2"), "local_code": F.lit(None).cast("string")}
    raw = spark.range(n).select([F.format_string("%06d", "id").alias("id")]).select([c.alias(name) for name, c in columns.items()])
    assert store_airports(raw, path, 6) == (n, n)

    def read_rows(code):
        df = read_stored(spark, path, AIRPORTS).filter(F.col("airport_code") == code)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        scans = plan.collectLeaves()
        return scans.apply(0).metrics().apply("numOutputRows").value()

    assert 0 < read_rows("i001500") < n / 3
    # Between two codes that are there, so only the bloom filter can tell.
    assert read_rows("i001500x") == 0
    for file in (tmp_path / "airports").glob("*.parquet"):
        codes = [r[0] for r in spark.read.parquet(str(file)).select("airport_code").collect()]
        assert codes == sorted(codes)
