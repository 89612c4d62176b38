import pytest
from helpers import plan_of, planned, rows
from pyspark.sql import functions as F

from arrivals.operators import Codes, DuplicateKey, dimension, dimensions, lookup


def table(spark, pairs, kind="bigint"):
    return spark.createDataFrame(pairs, f"code {kind}, name string")


def test_default_for_null_and_unknown_keys(spark):
    dim = dimension(Codes(table(spark, [(1, "one"), (2, "two")]), "code", "name", numeric=True))
    keys = [1.0, 2.0, None, 9.0, 2.5, float("nan")]
    facts = spark.createDataFrame(list(enumerate(keys, 1)), "i int, k double")
    found = rows(lookup(facts, dim, "k", "found", "none").select("i", "found"))
    assert found == [(1, "one"), (2, "two"), (3, "none"), (4, "none"), (5, "none"), (6, "none")]


def test_text_keys_of_a_numeric_code(spark):
    dim = dimension(Codes(table(spark, [(2, "two")]), "code", "name", numeric=True))
    facts = spark.createDataFrame([("2.0",), ("2",), ("x",), ("",), (None,)], "k string")
    assert rows(lookup(facts, dim, "k", "found", "none")) == [
        (None, "none"),
        ("", "none"),
        ("2", "two"),
        ("2.0", "two"),
        ("x", "none"),
    ]


def test_text_codes_compare_as_text(spark):
    dim = dimension(Codes(table(spark, [("06", "six"), ("AK", "ak")], "string"), "code", "name"))
    facts = spark.createDataFrame([("6",), ("06",), ("AK",), ("AK ",)], "k string")
    assert rows(lookup(facts, dim, "k", "found", "none")) == [
        ("06", "six"),
        ("6", "none"),
        ("AK", "ak"),
        ("AK ", "none"),
    ]


def test_null_value_takes_the_default_and_null_code_is_ignored(spark):
    names = table(spark, [(1, None), (None, "null"), (None, "null again")])
    dim = dimension(Codes(names, "code", "name", numeric=True))
    facts = spark.createDataFrame([(1.0,), (None,)], "k double")
    assert rows(lookup(facts, dim, "k", "found", "none")) == [(None, "none"), (1.0, "none")]


def test_duplicate_codes_are_rejected(spark):
    with pytest.raises(DuplicateKey, match="code '2.0' occurs 2 times"):
        dimension(Codes(table(spark, [(1, "a"), (2, "b"), (2, "c")]), "code", "name", numeric=True))
    with pytest.raises(DuplicateKey):
        dimension(Codes(table(spark, [("2", "b"), ("2.0", "c")], "string"), "code", "name", numeric=True))
    with pytest.raises(DuplicateKey):
        dimension(Codes(table(spark, [("0", "b"), ("-0.0", "c")], "string"), "code", "name", numeric=True))
    dimension(Codes(table(spark, [("2", "b"), ("2.0", "c")], "string"), "code", "name"))


def test_empty_dimension(spark):
    dim = dimension(Codes(table(spark, []), "code", "name", numeric=True))
    assert (dim.rows, dim.size_bytes, dim.broadcast) == (0, 0, True)
    assert rows(lookup(spark.createDataFrame([(1.0,)], "k double"), dim, "k", "found", "none")) == [(1.0, "none")]


def test_several_dimensions_are_checked_at_once(spark):
    none, one, two = table(spark, []), table(spark, [(1, "a")]), table(spark, [(1, "a"), (2, "b")])
    dims = dimensions(
        {
            "one": Codes(one, "code", "name"),
            "none": Codes(none, "code", "name"),
            "two": Codes(two, "code", "code", numeric=True),
        },
        broadcast_bytes=100,
    )
    found = {n: (d.rows, d.broadcast) for n, d in dims.items()}
    assert found == {"one": (1, True), "none": (0, True), "two": (2, False)}
    with pytest.raises(DuplicateKey, match="code 'x'"):
        repeated = table(spark, [("x", "a"), ("x", "b")], "string")
        dimensions({"one": Codes(one, "code", "name"), "repeated": Codes(repeated, "code", "name")})


def test_small_dimension_is_broadcast(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = dimension(Codes(table(spark, [(1, "one")]), "code", "name", numeric=True))
    facts = spark.range(100).select((F.col("id") % 3).cast("double").alias("k"))
    plan = planned(lookup(facts, dim, "k", "found", "none"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_dimension_beyond_the_bound_is_shuffled_and_hot_keys_are_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    names = spark.range(1000).select(F.col("id").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    dim = dimension(Codes(names, "code", "name", numeric=True), broadcast_bytes=1000)
    assert not dim.broadcast
    n = 40000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 2000)
    text = F.sha2(F.col("id").cast("string"), 256)
    facts = spark.range(0, n, 1, 16).select("id", key.cast("double").alias("k"), text.alias("text"))
    joined = lookup(facts, dim, "k", "found", "none")
    plan = plan_of(joined)
    assert "SortMergeJoin(skew=true)" in plan
    counts = {r["found"]: r["count"] for r in joined.groupBy("found").count().collect()}
    assert sum(counts.values()) == n
    expected_none = sum(1 for i in range(n) if i % 3 == 1 or (i % 3 == 2 and i % 2000 >= 1000))
    assert counts["none"] == expected_none
    assert counts["n7"] == sum(1 for i in range(n) if i % 3 == 0 or (i % 3 == 2 and i % 2000 == 7))


def test_facts_keep_their_columns_and_rows(spark):
    dim = dimension(Codes(table(spark, [(1, "one")]), "code", "name", numeric=True))
    facts = spark.createDataFrame([(1.0, "x"), (1.0, "x"), (5.0, "y")], "code double, name string")
    result = lookup(facts, dim, "code", "found", "none")
    assert result.columns == ["code", "name", "found"]
    assert rows(result) == [(1.0, "x", "one"), (1.0, "x", "one"), (5.0, "y", "none")]
