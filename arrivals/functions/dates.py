"""Date decoding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day 0 of the numeric dates, and the day numbers of 0001-01-01 and 9999-12-31.
EPOCH = "1960-01-01"
FIRST_DAY = -715509
LAST_DAY = 2936549


def sas_date(days: Column) -> Column:
    """ISO text of a day number counted from 1960-01-01.

    Fractions are floored. Null, NaN, 0 (which stands for "missing") and day numbers outside
    the years 1 to 9999 give null.
    """
    number = days.try_cast("double")
    whole = F.floor(number)
    valid = (number != 0) & ~F.isnan(number) & whole.between(FIRST_DAY, LAST_DAY)
    day = F.date_add(F.lit(EPOCH).cast("date"), whole.try_cast("int"))
    return F.when(valid, day.cast("string"))
