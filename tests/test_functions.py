import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from colsight.functions import interpret as I, text as T

KINDS = {
    "12": "int", " 12 ": "int", "+5": "int", "-7": "int", "1.5": "real", ".5": "real", "5.": "real", "-1.5e3": "real",
    "1e5": "unclassified", "nan": "unclassified", "INF": "unclassified", "99999999999999999999": "unclassified",
    "1.5d": "text", "1_000": "text", "12 MAIN ST": "text", "a:b": "text", "": "text", "2015-02-30": "text", None: None,
    "2015-02-03": "date", "02/03/2015": "date", "15 Feb 2015": "date",
}
DATES = {
    "2015-02-03": "2015-02-03 00:00:00", "02/03/2015": "2015-02-03 00:00:00", "13/02/2015": "2015-02-13 00:00:00",
    "02-03-15": "2015-02-03 00:00:00", "12-05-98": "1998-12-05 00:00:00", "02 03 2015": "2015-02-03 00:00:00",
    "15 Feb 2015": "2015-02-15 00:00:00", "Feb-15": "1970-02-15 00:00:00", "15-FEB-68": "2068-02-15 00:00:00",
    "2015-03": "2015-03-01 00:00:00", "Dec 2014": "2014-12-01 00:00:00", "10:30": "1970-01-01 10:30:00",
    "10:30 PM": "1970-01-01 22:30:00", "12:05 a.m.": "1970-01-01 00:05:00", "13:05 pm": None,
    "Mon, 3 March 2015 10:00:01": "2015-03-03 10:00:01", "2015-02-03T10:00:00.5Z": "2015-02-03 10:00:00.5",
    "2015-02-30": None, "2015-13-01": None, "Sept 5, 2019": None, "x" * 80 + " 10:30": None, "marble 12:00": None,
}


def test_kinds(spark):
    df = I.with_interpretation(spark.createDataFrame([(k,) for k in KINDS], "val string"))
    assert {r["val"]: r["kind"] for r in df.collect()} == KINDS


@pytest.mark.parametrize("staged", [True, False])
def test_dates(spark, staged):
    df = spark.createDataFrame([(k,) for k in DATES], "val string")
    ts = F.col("as_ts") if staged else I.interpret_datetime(F.col("val"))
    got = (I.with_interpretation(df) if staged else df).select("val", ts.cast("string").alias("ts"))
    assert {r["val"]: r["ts"] for r in got.collect()} == DATES


def test_levels(spark):
    values = ["Sept 5, 2019", "3 Feb", "Jan-5", "10:30", "2015-02-03", "12", "word"]
    df = spark.createDataFrame([(v,) for v in values], "val string")
    got = {}
    for level in ("high", "moderate", "low"):
        found = df.where(I.interpret_datetime(F.col("val"), level).isNotNull())
        got[level] = {r["val"] for r in found.collect()}
    assert got["high"] == {"10:30", "2015-02-03"}
    assert got["moderate"] == {"10:30", "2015-02-03", "Jan-5"}
    assert got["low"] == {"10:30", "2015-02-03", "Jan-5", "Sept 5, 2019", "3 Feb"}
    with pytest.raises(ValueError):
        I.date_gate(F.col("val"), "other")


def test_text_is_what_is_left(spark):
    df = spark.createDataFrame([(k,) for k in KINDS], "val string")
    got = {r["val"]: r["t"] for r in df.select("val", I.interpret_text(F.col("val")).alias("t")).collect()}
    assert got == {k: (k if kind == "text" else None) for k, kind in KINDS.items()}


SOUNDEX = {
    "ASHCRAFT": "A226", "WHITE": "W300", "SILVER": "S416", "PFISTER": "P236", "TYMCZAK": "T522", "BK": "B200", "": "",
    "O'Hara": "O600", "3M": "3500", "---": "", "a": "A000",
}


def test_soundex(spark):
    df = spark.createDataFrame([(k,) for k in SOUNDEX], "val string")
    got = {r["val"]: r["c"] for r in df.select("val", T.soundex_code(F.col("val")).alias("c")).collect()}
    assert got == SOUNDEX


def _grams(parts, n):
    return [tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n-é😀Z9", max_size=14), min_size=1, max_size=12))
def test_expressions_against_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t",
        T.char_ngrams(F.col("t")).alias("chars"),
        T.word_ngrams(F.col("t"), 2).alias("words"),
        T.word_ngrams(F.col("t"), 2, sentences=True).alias("sentences"),
        T.split_words(F.col("t")).alias("split"),
        T.first_word(F.col("t"), 3).alias("first"),
        T.clean_name(F.col("t")).alias("name"),
    )
    for r in df.collect():
        t = r["t"]
        assert r["chars"] == ["".join(g) for g in _grams(t, 3)]
        assert r["words"] == [" ".join(g) for g in _grams(re.sub("[^a-zA-Z]+", " ", t).split(), 2)]
        sentences = [re.sub("[^a-zA-Z]+", " ", s).split() for s in re.split(r"[.\n]", t)]
        assert r["sentences"] == [" ".join(g) for s in sentences for g in _grams(s, 2)]
        assert r["split"] == [w for w in t.lower().split(" ") if w]
        assert r["first"] == (t.split()[0][:3] if t.split() else "")
        assert r["name"] == re.sub(r"[^a-z0-9\s]", " ", t.lower())


def test_clean_words(spark):
    row = spark.createDataFrame([("A-B $1,2 #&",)], "t string").select(
        T.clean_words(F.col("t")).alias("a"), T.clean_words(F.col("t"), keep_dash=True).alias("b")
    ).first()
    assert (row["a"], row["b"]) == ("AB 12 ", "A-B 12 ")
