import pytest
from helpers import parquet_files, planned, rows
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from arrivals.schemas import SchemaMismatch, check_schema
from arrivals.sinks import write_partitioned, write_plain, write_ranged
from arrivals.sources import read_stored

SCHEMA = StructType(
    [StructField("id", LongType()), StructField("year", DoubleType()), StructField("port", StringType())]
)


def arrivals(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def directories(path):
    return sorted({str(f.parent.relative_to(path)) for f in parquet_files(path)})


def test_plain(spark, tmp_path):
    path = str(tmp_path / "out")
    df = arrivals(spark, (1, 2016.0, "060"), (2, None, None))
    assert write_plain(df, path) == 2
    assert rows(read_stored(spark, path, SCHEMA)) == rows(df)
    assert write_plain(df.limit(1), path) == 1
    assert read_stored(spark, path, SCHEMA).count() == 1


def test_partition_values_survive(spark, tmp_path):
    path = tmp_path / "out"
    df = arrivals(
        spark, (1, 2016.0, "060"), (2, 2016.0, "61"), (3, None, "60"), (4, 2015.0, None), (5, 2015.5, "A/B = C")
    )
    assert write_partitioned(df, str(path), ["year", "port"]) == 5
    assert "year=2016.0/port=060" in directories(path)
    assert "year=2015.0/port=__HIVE_DEFAULT_PARTITION__" in directories(path)
    stored = read_stored(spark, str(path), SCHEMA)
    check_schema(stored, SCHEMA)
    assert rows(stored) == rows(df)


def test_small_partitions_get_one_file(spark, tmp_path):
    port = (F.col("id") % 20).cast("string")
    df = spark.range(0, 4000, 1, 16).select("id", F.lit(2016.0).alias("year"), port.alias("port"))
    assert write_partitioned(df, str(tmp_path / "out"), ["year", "port"]) == 4000
    assert len(parquet_files(tmp_path / "out")) == 20


def test_a_hot_partition_is_divided_over_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    port = F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 20).cast("string"))
    text = F.sha2(F.col("id").cast("string"), 256)
    df = spark.range(0, 60000, 1, 16).select("id", text.alias("text"), port.alias("port"))
    assert write_partitioned(df, str(tmp_path / "out"), ["port"]) == 60000
    assert len(parquet_files(tmp_path / "out" / "port=HOT")) > 4
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 60000
    assert stored.select("id").distinct().count() == 60000


def test_equal_rows_in_a_hot_partition_are_divided_too(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB")
    df = spark.range(0, 60000, 1, 16).select(F.lit("same").alias("text"), F.lit("HOT").alias("port"))
    assert write_partitioned(df, str(tmp_path / "out"), ["port"]) == 60000
    assert len(parquet_files(tmp_path / "out")) > 4


def test_overwrite_replaces_all_or_only_the_partitions_written(spark, tmp_path):
    path = str(tmp_path / "out")
    april = arrivals(spark, (1, 2016.0, "A"), (2, 2016.0, "B"))
    may = arrivals(spark, (3, 2017.0, "A"), (4, 2016.0, "B"))
    write_partitioned(april, path, ["year", "port"])
    assert write_partitioned(may, path, ["year", "port"], replace="partitions") == 2
    assert rows(read_stored(spark, path, SCHEMA).select("id")) == [(1,), (3,), (4,)]
    write_partitioned(may, path, ["year", "port"])
    assert rows(read_stored(spark, path, SCHEMA).select("id")) == [(3,), (4,)]


def test_session_default_does_not_change_a_full_overwrite(spark, tmp_path, conf):
    conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    path = str(tmp_path / "out")
    write_partitioned(arrivals(spark, (1, 2016.0, "A")), path, ["port"])
    write_partitioned(arrivals(spark, (2, 2016.0, "B")), path, ["port"])
    assert rows(read_stored(spark, path, SCHEMA).select("id")) == [(2,)]


def test_ranges(spark, tmp_path):
    path = tmp_path / "out"
    port = (F.col("id") % 100).cast("string")
    df = spark.range(0, 3000, 1, 8).select("id", F.lit(2016.0).alias("year"), port.alias("port"))
    assert write_ranged(df, str(path), ["port", "year"]) == 3000
    files = parquet_files(path)
    assert len(files) == 3
    spans = sorted(spark.read.parquet(str(f)).agg(F.min("port"), F.max("port")).first() for f in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert rows(read_stored(spark, str(path), SCHEMA)) == rows(df)


def test_a_hot_range_key_is_divided(spark, tmp_path):
    path = tmp_path / "out"
    port = F.when(F.col("id") % 10 < 9, "HOT").otherwise((F.col("id") % 100).cast("string"))
    df = spark.range(0, 9000, 1, 8).select("id", F.lit(2016.0).alias("year"), port.alias("port"))
    assert write_ranged(df, str(path), ["port"], files=6) == 9000
    sizes = [spark.read.parquet(str(f)).count() for f in parquet_files(path)]
    assert len(sizes) == 6
    assert max(sizes) < 9000 / 3
    assert rows(read_stored(spark, str(path), SCHEMA)) == rows(df)


def test_equal_rows_are_divided_over_ranges(spark, tmp_path):
    path = tmp_path / "out"
    same = {"id": F.lit(1).cast("bigint"), "year": F.lit(2016.0), "port": F.lit("A")}
    df = spark.range(0, 9000, 1, 40).select([value.alias(name) for name, value in same.items()])
    assert write_ranged(df, str(path), ["port"], files=6) == 9000
    sizes = [spark.read.parquet(str(f)).count() for f in parquet_files(path)]
    assert len(sizes) == 6
    assert max(sizes) < 9000 / 3
    assert spark.read.parquet(str(path)).columns == ["id", "year", "port"]


def test_empty_results(spark, tmp_path):
    empty = arrivals(spark).filter("id > 0")
    assert write_plain(empty, str(tmp_path / "plain")) == 0
    assert write_partitioned(empty, str(tmp_path / "parts"), ["port"]) == 0
    assert write_ranged(empty, str(tmp_path / "ranges"), ["port"]) == 0
    assert read_stored(spark, str(tmp_path / "plain"), SCHEMA).count() == 0


def test_reading_a_layout_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(arrivals(spark, (1, 2016.0, "A"), (2, 2017.0, "B")), path, ["year", "port"])
    plan = planned(read_stored(spark, path, SCHEMA).filter("year = 2016 and port = 'A'").select("id"))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_schema_check(spark):
    df = arrivals(spark, (1, 2016.0, "A"))
    assert check_schema(df, SCHEMA) is df
    others = (
        df.drop("port"),
        df.select("year", "id", "port"),
        df.withColumn("id", F.lit("1")),
        df.withColumn("x", F.lit(1)),
    )
    for other in others:
        with pytest.raises(SchemaMismatch):
            check_schema(other, SCHEMA)
