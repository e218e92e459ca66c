"""Dates: spellings of a value, and conventions of a column."""

import pytest
from pyspark.sql import functions as F

from colsight.functions import interpret as I
from colsight.operators import dates as D, generic
from colsight.operators.cells import TEXT

SPELLINGS = {
    "Thu Sep 25 10:36:28 2003": "2003-09-25 10:36:28", "Thu Sep 25 10:36:28 EDT 2003": "2003-09-25 10:36:28", "2015-02-03 12:15:01 EST": "2015-02-03 12:15:01",
    "20150203T121501": "2015-02-03 12:15:01", "20150203T1215": "2015-02-03 12:15:00", "20150203 12:15": "2015-02-03 12:15:00", "May 5th, 2001 at 5pm": "2001-05-05 17:00:00",
    "May 5, 2001 12am": "2001-05-05 00:00:00", "3rd of May 2001": "2001-05-03 00:00:00", "the 1st of June, 1999 10:00": "1999-06-01 10:00:00", "2015-02-03 12h15m": "2015-02-03 12:15:00",
    "2015-02-03 12h15m30s": "2015-02-03 12:15:30", "2015-02-03 12h": None, "2015-02-30 12h15m": None, "20151303T121501": None, "est": None, "3rd of 2001": None, "2015-02-03 25pm": None,
}


def test_spellings(spark):
    df = spark.createDataFrame([(v,) for v in SPELLINGS], "val string")
    got = {r.val: r.t for r in df.select("val", I.parse_datetime(F.col("val")).cast("string").alias("t")).collect()}
    assert got == SPELLINGS


def read(spark, columns, **options):
    rows = [("d", c, TEXT, v, n) for c, values in columns.items() for v, n in values]
    vc = spark.createDataFrame(rows, "dataset string, column_name string, bucket string, val string, count bigint")
    return {(r.column_name, r.val): r.t for r in generic.with_kind(vc, **options).select("column_name", "val", F.col("as_ts").cast("string").alias("t")).collect()}


def test_votes_are_cells(spark):
    columns = {
        "european": [("03/04/2015", 5), ("25/12/2015", 1), ("12/2/2015 10:30 pm", 1)],
        "american": [("03/04/2015", 5), ("12/25/2015", 1)],
        "outvoted": [("03/04/2015", 5), ("12/25/2015", 1), ("25/12/2015", 2)],
        "tied": [("03/04/2015", 5), ("12/25/2015", 2), ("25/12/2015", 2)],
        "old": [("3 May 42", 1), ("04-05-39", 1), ("31-12-1940", 3), ("1950-01-01", 1)],
        "future": [("01/02/71", 1), ("2060-01-01", 1)],
        "plain": [("01/02/71", 1), ("01/02/17", 1), ("no date", 3), (None, 2), ("", 1), ("12", 1)],
    }
    got = read(spark, columns, by_column=True)
    day = {k: v and v[:10] for k, v in got.items()}
    assert day["european", "03/04/2015"] == "2015-04-03" and day["european", "25/12/2015"] == "2015-12-25"
    assert got["european", "12/2/2015 10:30 pm"] == "2015-02-12 22:30:00"
    assert day["american", "03/04/2015"] == "2015-03-04"
    assert day["outvoted", "03/04/2015"] == "2015-04-03" and day["outvoted", "12/25/2015"] == "2015-12-25"
    assert day["tied", "03/04/2015"] == "2015-03-04"
    assert day["old", "3 May 42"] == "1942-05-03" and day["old", "04-05-39"] == "1939-05-04" and day["old", "31-12-1940"] == "1940-12-31"
    assert day["future", "01/02/71"] == "2071-01-02"
    assert day["plain", "01/02/71"] == "1971-01-02" and day["plain", "01/02/17"] == "2017-01-02"
    assert {v for (c, _), v in got.items() if c == "plain" and _ in ("no date", None, "", "12")} == {None}


@pytest.mark.parametrize("level", ["high", "moderate", "low"])
def test_single_values_are_read_as_before(spark, level):
    """Without votes a column's values read as each by itself."""
    values = [("15 Feb 2015", 1), ("02-03-15", 1), ("2015-02", 1), ("Feb-15", 1), ("12:30", 1), ("2015-02-03T12:15:01+01:00", 1)]
    one = {f"c{i}": [v] for i, v in enumerate(values)}
    assert read(spark, one, level=level, by_column=True) == read(spark, one, level=level)


def test_masks(spark):
    cases = {"3/4/2015": {"month first", "day first", "four-digit year"}, "25/4/15": {"day first"}, "4/25/15": {"month first"}, "2015-4-25": {"year first", "four-digit year"},
             "3 may 2015": {"month by name", "four-digit year"}, "32/1/2015": {"four-digit year"}, "12:2015": set(), "": set()}
    df = spark.createDataFrame([(v,) for v in cases], "val string").select("val", D.layout_mask(F.col("val")).alias("m"))
    assert {r.val: {n for n, b in D.BIT.items() if r.m & b} for r in df.collect()} == cases
