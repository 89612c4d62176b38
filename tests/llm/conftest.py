import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

WORDS = [f"w{i}" for i in range(400)]
EXTRA = ["size", "key", "set", "seed", "target", "found", "whole", "spans", "language", "words"]
SCHEMA = StructType(
    [StructField("doc_id", LongType()), *[StructField(c, StringType()) for c in ("text", "lang", "source")]]
    + [StructField(c, StringType()) for c in EXTRA]
)


def passage(start, n):
    return " ".join(WORDS[(start * 7 + i * i + 3 * i) % 400] for i in range(n))


@pytest.fixture(scope="session")
def make(spark):
    def of(rows):
        return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)

    return of


ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t ", None, "a"),
    (None, "alone without an id, but with words", "en", "b"),
    (4, "the same text here", "en", "a"),
    (4, "the same text here", "en", "a"),
    (5, "the  same text\nhere", "de", "b"),
    (6, passage(1, 20_000), "en", "a"),
    (7, "l1\nl2\nl3\nl4", "en", "a"),
    (8, "x\nl1\n\nl2 \nl3\nl4\ny", "fr", "b"),
    (9, "日本語 123 !!", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)
