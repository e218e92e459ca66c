"""Date layouts settled per column.

`03/04/2015` is March 4 in one column and 3 April in another, and `42` is a year of some century. One
value can't tell; its column can. Every distinct value says by a bitmask which layouts read it, the
column's values vote with their counts, and each value is then parsed once by what was settled:

* day first, if more cells can only be read so (`25/12/2015`) than can only be read month first;
  month first otherwise;
* two-digit years lie within fifty years of the mean four-digit year of the column's dates; without
  any, 69 to 99 are 1969 to 1999.

Values that only one order reads are read in that order whatever the column says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from colsight.functions import interpret as I
from colsight.operators.cells import KEY

_DAY, _MONTH, _SEP, _YEAR = r"(?:0?[1-9]|[12][0-9]|3[01])", r"(?:0?[1-9]|1[0-2])", r"[-/ .]", r"(?:[0-9]{4}|[0-9]{2})"
LAYOUTS = {
    "month first": f"^{_MONTH}{_SEP}{_DAY}{_SEP}{_YEAR}(?![0-9])",
    "day first": f"^{_DAY}{_SEP}{_MONTH}{_SEP}{_YEAR}(?![0-9])",
    "year first": f"^[0-9]{{4}}{_SEP}{_MONTH}{_SEP}{_DAY}(?![0-9])",
    "month by name": f"(?:^|[^a-z])(?:{I.MONTH_NAME})(?:[^a-z]|$)",
    "four-digit year": r"(?:^|[^0-9:.])[0-9]{4}(?:[^0-9:]|$)",
}
BIT = {name: 1 << i for i, name in enumerate(LAYOUTS)}


def layout_mask(bare: Column) -> Column:
    """A bit for each of LAYOUTS that reads the (trimmed, lower-cased) value."""
    return reduce(lambda acc, name: acc + F.when(bare.rlike(LAYOUTS[name]), BIT[name]).otherwise(0), LAYOUTS, F.lit(0)).cast("int")


def _votes(only: str, other: str) -> Column:
    both = BIT[only] | BIT[other]
    return F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(both) == BIT[only], F.col("count"))), F.lit(0)).cast("bigint")


def conventions(values: DataFrame) -> DataFrame:
    """(dataset, column_name, day_votes, month_votes, day_first, middle_year) from values with `_bare`."""
    year = F.regexp_extract("_bare", r"(?:^|[^0-9:.])([0-9]{4})(?:[^0-9:]|$)", 1).try_cast("int")
    dated = F.col("mask") >= BIT["month first"]
    weight = F.when(dated & year.isNotNull(), F.col("count"))
    read = values.where("_bare IS NOT NULL").withColumn("mask", layout_mask(F.col("_bare")))
    votes = read.groupBy(*KEY).agg(
        _votes("day first", "month first").alias("day_votes"),
        _votes("month first", "day first").alias("month_votes"),
        F.round(F.sum(weight * year) / F.sum(weight)).cast("int").alias("middle_year"),
    )
    return votes.withColumn("day_first", F.col("day_votes") > F.col("month_votes"))


def settled(values: DataFrame) -> DataFrame:
    """Adds `_iso`: each value of `(dataset, column_name, count, _bare, ...)` as its column's conventions read it."""
    chosen = conventions(values).select(*KEY, "day_first", "middle_year")
    both = BIT["day first"] | BIT["month first"]
    open_order = layout_mask(F.col("_bare")).bitwiseAND(both) == both
    turned = F.regexp_replace("_bare", f"^([0-9]{{1,2}})({_SEP})([0-9]{{1,2}})", "$3$2$1")
    out = values.join(chosen, list(KEY), "left").withColumn("_turned", F.when(F.col("day_first") & open_order, turned).otherwise(F.col("_bare")))
    out = out.withColumn("_raw", I.rewritten(F.col("_turned")))
    short = F.regexp_extract("_raw", "^~([0-9]{2})-", 1).try_cast("int")
    whole = short + 100 * F.round((F.col("middle_year") - short) / 100).cast("int")
    by_column = F.concat(F.lit("~"), F.lpad(whole.cast("string"), 4, "0"), F.substring("_raw", 4, 100))
    iso = F.when(short.isNotNull() & F.col("middle_year").isNotNull(), by_column).otherwise(I.in_century(F.col("_raw")))
    return out.withColumn("_iso", iso).drop("_turned", "_raw", "day_first", "middle_year")


def column_conventions(vc: DataFrame, level: str = "high") -> DataFrame:
    """(dataset, column_name, day_votes, month_votes, middle_year, day_first) of value counts."""
    return conventions(I.with_bare(vc, "val", level))
