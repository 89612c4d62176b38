"""Left outer lookups of a code in a dimension table, with a default for misses."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast up to this measured size; beyond it the join is left to Spark.
BROADCAST_BYTES = 10 * 1024 * 1024
# Rough cost of a row in a broadcast relation besides its text.
ROW_BYTES = 64

_CODE = "__code"
_VALUE = "__value"


class DuplicateKey(ValueError):
    """A dimension has several rows for one code, so a lookup would multiply rows."""


@dataclass(frozen=True)
class Dimension:
    """Code and value columns with unique codes, and their measured size."""

    pairs: DataFrame
    numeric: bool
    rows: int
    size_bytes: int
    broadcast: bool


@dataclass(frozen=True)
class Codes:
    """A table to look codes up in: its code column and its value column.

    With `numeric`, codes of either side are compared as doubles, so 2 matches 2.0 and '2.0';
    text that is no number is like null. Null codes match nothing.
    """

    table: DataFrame
    code: str
    value: str
    numeric: bool = False

    def pairs(self) -> DataFrame:
        # Adding 0.0 turns -0.0 into 0.0, which it equals in a join.
        key = F.col(self.code).try_cast("double") + 0.0 if self.numeric else F.col(self.code).cast("string")
        return self.table.select(key.alias(_CODE), F.col(self.value).alias(_VALUE)).filter(F.col(_CODE).isNotNull())


def _entries(name: str, pairs: DataFrame) -> DataFrame:
    """Table name, code as text, and size of each pair."""
    code = F.col(_CODE).cast("string")
    width = F.octet_length(code) + F.coalesce(F.octet_length(F.col(_VALUE).cast("string")), F.lit(0)) + ROW_BYTES
    return pairs.select(F.lit(name).alias("name"), code.alias("code"), width.alias("bytes"))


def dimensions(tables: dict[str, Codes], broadcast_bytes: int = BROADCAST_BYTES) -> dict[str, Dimension]:
    """Check tables for use in lookups: measure them, and fail if a code occurs twice.

    One action for all of them, which returns one row for each. Repeated codes collapse before
    the shuffle.
    """
    pairs = {name: codes.pairs() for name, codes in tables.items()}
    measures = (
        reduce(DataFrame.unionByName, [_entries(name, p) for name, p in pairs.items()])
        .groupBy("name", "code")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("codes"),
            F.sum("bytes").alias("bytes"),
            F.max("n").alias("most"),
            F.max_by("code", "n").alias("most_frequent"),
        )
    )
    by_name = {m["name"]: m for m in measures.collect()}
    checked = {}
    for name, codes in tables.items():
        if name not in by_name:  # no pairs at all
            checked[name] = Dimension(pairs[name], codes.numeric, 0, 0, True)
            continue
        m = by_name[name]
        if m["most"] > 1:
            raise DuplicateKey(f"{codes.code} {m['most_frequent']!r} occurs {m['most']} times")
        checked[name] = Dimension(pairs[name], codes.numeric, m["codes"], m["bytes"], m["bytes"] <= broadcast_bytes)
    return checked


def dimension(codes: Codes, broadcast_bytes: int = BROADCAST_BYTES) -> Dimension:
    """The same for one table."""
    return dimensions({"": codes}, broadcast_bytes)[""]


def lookup(facts: DataFrame, dim: Dimension, key: str, into: str, default: str, missed: str | None = None) -> DataFrame:
    """Add column `into`: the value `dim` has for `key`, or `default` where there is none.

    Every fact row is kept exactly once. A dimension within its size bound is broadcast, so the
    facts are neither moved nor sorted. A larger one is joined by shuffle; adaptive execution
    then splits partitions swollen by one hot key, or by null keys, over several tasks. With `missed`, a
    column of that name tells the rows whose code `dim` does not have.
    """
    fact_key = F.col(key).try_cast("double") if dim.numeric else F.col(key).cast("string")
    pairs = F.broadcast(dim.pairs) if dim.broadcast else dim.pairs
    new = {into: F.coalesce(F.col(_VALUE), F.lit(default))}
    if missed:
        new[missed] = F.col(_CODE).isNull()
    return facts.join(pairs, fact_key == F.col(_CODE), "left").withColumns(new).drop(_CODE, _VALUE)
