"""Months published in all layouts at once."""

import pytest
from helpers import parquet_files, planned, rows
from pyspark.sql import functions as F

from arrivals.schemas import SchemaMismatch
from arrivals.sinks import months, publications, publish, published, read_published, remove_replaced
from arrivals.sinks.months import IncompleteLoad

LAYOUTS = {"_state": ["year", "month", "state"], "_port": ["year", "month", "mode", "port"]}


def facts(spark, *data):
    return spark.createDataFrame([(float(m), *r) for m, *r in data], "month double, state string, mode string, port string, id bigint").select(
        "id", F.lit(2016.0).alias("year"), "month", "state", "mode", "port"
    )


def stored(spark, path, df):
    return [rows(read_published(spark, path, layout, df.schema)) for layout in LAYOUTS]


def test_months_are_replaced_whole_in_both_layouts(spark, tmp_path):
    path = str(tmp_path / "out")
    first = facts(spark, (4, "A", "air", "060", 1), (4, "B", None, None, 2), (5, "A", "sea", "X", 3))
    assert publish(first, path, LAYOUTS, 2) == {"rows": 3}
    assert stored(spark, path, first) == [rows(first)] * 2
    again = facts(spark, (4, "C", "air", "Y", 4), (6, "A", "air", "Y", 5))
    counts = publish(again.withColumn("mark", F.col("id") % 2), path, LAYOUTS, 2, {"odd": F.sum("mark")}, ["mark"])
    assert counts == {"rows": 2, "odd": 1}
    expected = rows(first.filter("month = 5").unionByName(again))
    assert stored(spark, path, first) == [expected] * 2
    assert sorted(published(spark, path)) == [f"year=2016.0/month={m}.0" for m in (4, 5, 6)]
    assert publications(spark, path).agg(F.max("publication"), F.sum("rows")).first() == (2, 5)


@pytest.mark.parametrize("dies", ["second layout", "publication"])
def test_a_killed_load_leaves_the_earlier_version(spark, tmp_path, monkeypatch, dies):
    path = str(tmp_path / "out")
    first = facts(spark, (4, "A", "air", "060", 1), (5, "A", "sea", "X", 3))
    publish(first, path, LAYOUTS, 2)
    write, calls = months.write_counted, []

    def killed(df, folder, *rest):
        calls.append(folder)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return write(df, folder, *rest)

    if dies == "second layout":
        monkeypatch.setattr(months, "write_counted", killed)
    else:
        monkeypatch.setattr(months, "PUBLICATIONS", None)
    changed = facts(spark, (4, "Z", "air", "060", 9))
    with pytest.raises((KeyboardInterrupt, Exception)):
        publish(changed, path, LAYOUTS, 2)
    monkeypatch.undo()
    assert stored(spark, path, first) == [rows(first)] * 2
    # Repeated, the load goes through, and what is left over can be removed.
    publish(changed, path, LAYOUTS, 2)
    expected = rows(changed.unionByName(first.filter("month = 5")))
    assert stored(spark, path, first) == [expected] * 2
    if dies == "second layout":
        assert len(remove_replaced(spark, path, LAYOUTS)) == 1
    assert remove_replaced(spark, path, LAYOUTS) == []
    assert stored(spark, path, first) == [expected] * 2


def test_replaced_versions_are_removed_once_no_month_needs_them(spark, tmp_path):
    path = str(tmp_path / "out")
    first = facts(spark, (4, "A", "air", "060", 1), (5, "A", "sea", "X", 3))
    for df in (first, first.filter("month = 4"), first.filter("month = 5")):
        publish(df, path, LAYOUTS, 2)
    assert len(remove_replaced(spark, path, LAYOUTS)) == 1
    assert stored(spark, path, first) == [rows(first)] * 2
    assert len(parquet_files(tmp_path / "out_state")) == 2


def test_another_type_is_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "out")
    first = facts(spark, (4, "A", "air", "060", 1))
    publish(first, path, LAYOUTS, 2)
    files = parquet_files(tmp_path)
    for other in (first.withColumn("id", F.lit("1")), first.withColumn("more", F.lit(1))):
        with pytest.raises(SchemaMismatch):
            publish(other, path, LAYOUTS, 2)
    assert parquet_files(tmp_path) == files
    assert stored(spark, path, first) == [rows(first)] * 2


def test_layouts_that_differ_are_not_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    first = facts(spark, (4, "A", "air", "060", 1), (5, "A", "sea", "X", 3))
    write = months.write_counted
    monkeypatch.setattr(months, "write_counted", lambda df, folder, *rest: write(df.filter("id = 1") if "_port" in folder else df, folder, *rest))
    with pytest.raises(IncompleteLoad):
        publish(first, path, LAYOUTS, 2)
    assert published(spark, path) == {}


def test_one_scan_for_each_layout_and_pruned_reads(spark, tmp_path):
    path, source = str(tmp_path / "out"), str(tmp_path / "in")
    many = facts(spark, *[(m, s, "air", "P", i) for i, (m, s) in enumerate((m, s) for m in range(1, 9) for s in "ABC")])
    many.write.parquet(source)
    df = spark.read.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(i):
        reads.add(1)
        return i

    publish(df.withColumn("id", seen.asNondeterministic()("id")), path, LAYOUTS, 2)
    assert reads.value == 2 * 24
    plan = planned(read_published(spark, path, "_state", df.schema).filter("month = 3").select("id"))
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:200]


def test_no_rows_and_no_publication(spark, tmp_path):
    path = str(tmp_path / "out")
    none = facts(spark, (4, "A", "air", "060", 1)).filter("id > 1")
    assert publish(none, path, LAYOUTS, 2) == {"rows": 0}
    assert stored(spark, path, none) == [[], []] and remove_replaced(spark, str(tmp_path / "other"), LAYOUTS) == []
