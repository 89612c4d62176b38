import random

from helpers import parquet_files, planned, rows
from pyspark.sql import functions as F

from arrivals.operators import dedup
from arrivals.plans import clean_demographics, store_demographics
from arrivals.schemas import DEMOGRAPHICS, check_schema
from arrivals.sources import read_demographics, read_stored

HEADER = "a;b;c;d;e;f;g;h;i;j;k;l"


def read(spark, tmp_path, *lines):
    path = tmp_path / "demographics.csv"
    path.write_text("\n".join([HEADER, *lines, ""]))
    return read_demographics(spark, str(path))


def test_scan_binds_by_position_and_bad_numbers_are_null(spark, tmp_path):
    raw = read(spark, tmp_path, "Ury;Kansas;33.5;10;11;21;n/a;;2.5;KS;Red;7", "Ury;Kansas;x;;11;21.5;1;2;2.5;KS;Red;7")
    check_schema(raw, DEMOGRAPHICS)
    assert rows(raw) == [
        ("Ury", "Kansas", None, None, "11", None, 1, 2, 2.5, "KS", "Red", 7),
        ("Ury", "Kansas", 33.5, "10", "11", 21, None, None, 2.5, "KS", "Red", 7),
    ]


def test_null_states_and_repeated_keys_are_removed(spark, tmp_path):
    raw = read(
        spark,
        tmp_path,
        "Ury;Kansas;33.5;10;11;21;1;2;2.5;KS;Red;7",
        "Ury;Kansas;30.5;12;11;23;1;2;2.5;KS;Red;9",
        "Ury;Kansas;;13;11;24;1;2;2.5;KS;Blue;9",
        "Ury;Kansas;31.5;13;11;24;1;2;2.5;KS;Blue;9",
        "Ury;;30.5;12;11;23;1;2;2.5;KS;Red;9",
        "Ury;Iowa;30.5;12;11;23;1;2;2.5;IA;;9",
        "Ury;Iowa;30.5;12;11;23;1;2;2.5;IA;;9",
    )
    cleaned = clean_demographics(raw)
    check_schema(cleaned, DEMOGRAPHICS)
    assert rows(cleaned.select("state", "city", "race", "median_age", "count")) == [
        ("Iowa", "Ury", None, 30.5, 9),
        ("Kansas", "Ury", "Blue", None, 9),
        ("Kansas", "Ury", "Red", 30.5, 9),
    ]


def test_store(spark, tmp_path):
    raw = read(spark, tmp_path, *[f"City {i % 9};State {i % 3};{i}.5;1;2;3;4;5;6.0;S;R{i % 2};{i}" for i in range(60)])
    target = tmp_path / "stored"
    assert store_demographics(raw, str(target)) == (60, 18)
    assert sorted(p.name for p in target.iterdir() if p.is_dir()) == ["state=State 0", "state=State 1", "state=State 2"]
    assert len(parquet_files(target)) == 3
    assert rows(read_stored(spark, str(target), DEMOGRAPHICS)) == rows(clean_demographics(raw))


def test_dedup_takes_the_least_row_however_the_input_is_partitioned(spark):
    random.seed(5)
    value = [None, 1, 2, 3]
    data = [(random.choice("ab"), random.choice(value), random.choice(value), random.choice(value)) for _ in range(200)]
    df = spark.createDataFrame(data, "k1 string, v1 int, k2 int, v2 int")

    def low(v):
        return (v is not None, v or 0)

    expected = {}
    for k1, v1, k2, v2 in data:
        best = expected.get((k1, k2))
        if best is None or (low(v2), low(v1)) < (low(best[3]), low(best[1])):
            expected[k1, k2] = (k1, v1, k2, v2)
    for parts in (1, 7):
        result = dedup(df.repartition(parts), ["k1", "k2"], ["v2"])
        assert result.columns == df.columns
        assert rows(result) == rows(spark.createDataFrame(list(expected.values()), df.schema))


def test_dedup_on_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a")], "k int, v string")
    assert rows(dedup(df, ["k", "v"])) == [(None, "a"), (1, "a")]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 6).select(F.lit("hot").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    plan = planned(dedup(df, ["k"]))
    assert "partial_min" in plan
    assert "Window" not in plan
    assert plan.count("Exchange") == 1
