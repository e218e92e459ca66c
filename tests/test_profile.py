import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from colsight.operators import cells, generic
from colsight.plans import profile as P


@pytest.fixture(scope="module")
def messy(spark):
    """The shapes of a messy file: odd names, gaps, several types in one column."""
    data = [
        ("Feb-15", "hi", 1.5, True, 1, datetime.date(2020, 1, 1)),
        ("Apr-16", "491176", None, False, 2, None),
        ("2343", "1.25", 2.5, None, 3, datetime.date(2021, 5, 1)),
        ("2343", None, 2.5, True, None, datetime.date(2019, 5, 1)),
        ("", "2.75", float("nan"), True, 5, None),
        (None, "1e5", 4.0, True, 6, None),
    ]
    schema = "`Mo.nth` string, `Single Issue` string, total double, flag boolean, id int, day date"
    return spark.createDataFrame(data, schema)


def _columns(df):
    return {r["column_name"]: r for r in df.collect()}


def test_counts(spark, messy, rows):
    vc = cells.value_counts({"m": messy})
    counts = {r["column_name"]: (r["non_empty"], r["empty"], r["distinct_values"]) for r in cells.distinct_counts(vc).collect()}
    assert counts == {"Mo.nth": (5, 1, 4), "Single Issue": (5, 1, 5), "total": (5, 1, 4), "flag": (5, 1, 2), "id": (5, 1, 5), "day": (3, 3, 3)}
    wide = {r["column_name"]: (r["non_empty"], r["empty"]) for r in cells.cell_counts({"m": messy}).collect()}
    assert wide == {k: v[:2] for k, v in counts.items()}
    approx = {r["column_name"]: r["distinct_values"] for r in cells.approx_distinct_counts({"m": messy}).collect()}
    assert approx == {k: v[2] for k, v in counts.items()}
    assert {r["column_name"] for r in cells.key_candidates(vc).collect()} == {"Single Issue", "id", "day"}
    # three empty cells are the same value, one is a value of its own
    assert {r["column_name"] for r in cells.key_candidates(vc, strict=True).collect()} == {"Single Issue", "id"}


def test_value_counts_do_not_depend_on_partitions(messy, rows):
    assert rows(cells.value_counts({"m": messy.repartition(3)})) == rows(cells.value_counts({"m": messy.coalesce(1)}))


def test_kinds_add_up(messy):
    vc = cells.value_counts({"m": messy})
    non_empty = {r["column_name"]: r["non_empty"] for r in cells.distinct_counts(vc).collect()}
    for r in generic.mixed_type_counts(vc).collect():
        assert r["n_int"] + r["n_real"] + r["n_date"] + r["n_text"] + r["n_unclassified"] == non_empty[r["column_name"]]


@pytest.mark.parametrize("staged", [True, False])
def test_profile(messy, staged):
    got = _columns(P.profile_columns({"m": messy}, staged=staged))
    month = {e["type"]: e for e in got["Mo.nth"]["data_types"]}
    assert [e["type"] for e in got["Mo.nth"]["data_types"]] == ["INTEGER (LONG)", "DATE/TIME", "TEXT"]
    assert (month["INTEGER (LONG)"]["count"], month["INTEGER (LONG)"]["mean"]) == (2, 2343.0)
    assert (month["DATE/TIME"]["max_value"], month["DATE/TIME"]["min_value"]) == ("Apr-16", "Feb-15")
    assert (month["TEXT"]["count"], month["TEXT"]["shortest_values"], month["TEXT"]["average_length"]) == (1, None, None)
    assert got["Mo.nth"]["frequent_values"] == ["2343", "", "Apr-16", "Feb-15"]
    single = {e["type"]: e for e in got["Single Issue"]["data_types"]}
    assert set(single) == {"INTEGER (LONG)", "REAL", "TEXT"}
    assert (single["REAL"]["max_value"], single["REAL"]["min_value"], single["REAL"]["mean"]) == ("2.75", "1.25", 2.0)
    flag = got["flag"]["data_types"][0]
    assert (flag["type"], flag["count"], flag["longest_values"]) == ("TEXT", 5, ["false", "true", "true", "true", "true"])
    day = got["day"]["data_types"][0]
    assert (day["type"], day["max_value"], day["min_value"]) == ("DATE/TIME", "2021-05-01", "2019-05-01")
    nested = P.nest(P.profile_columns({"m": messy}, staged=staged)).first()
    assert nested["key_column_candidates"] == ["Single Issue", "day", "id"]
    assert len(nested["columns"]) == 6


def test_spread_of_one_row(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert generic.numeric_stats({"a": df}).first()["stddev"] is None
    assert generic.numeric_stats({"a": df}, nan_to_zero=True).first()["stddev"] == 0


def test_decimal_scale_decides():
    assert cells.bucket_of(T.DecimalType(20, 0)) == cells.INTEGER
    assert cells.bucket_of(T.DecimalType(20, 10)) == cells.REAL
    assert cells.bucket_of(T.ArrayType(T.StringType())) is None


def test_repeated_rows_in_extremes(spark):
    df = spark.createDataFrame([("aa",)] * 3 + [("b",)] * 2 + [("cccc",)], "t string")
    vc = cells.value_counts({"x": df})
    assert [r["val"] for r in generic.text_extremes(vc, longest=False).orderBy("rank").collect()] == ["b", "b", "aa", "aa", "aa"]
    assert [r["val"] for r in generic.text_extremes(vc, longest=True).orderBy("rank").collect()] == ["cccc", "aa", "aa", "aa", "b"]
    distinct = generic.text_extremes(vc, longest=True, distinct=True).orderBy("rank")
    assert [r["val"] for r in distinct.collect()] == ["cccc", "aa", "b"]


def test_hot_value(spark):
    """A value that fills a third of a table changes nothing but its count."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("t"))
    top = generic.frequent_values(cells.value_counts({"x": df})).orderBy("rank").collect()
    assert (top[0]["val"], top[0]["count"], len(top)) == ("HOT", 3000, 5)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("t"))
    plan = _plan(generic.frequent_values(cells.value_counts({"x": df})))
    assert plan.count("WindowGroupLimit") == 2


def test_plans_stay_in_the_jvm(spark, messy):
    plan = _plan(P.flatten(P.profile_columns({"m": messy}, staged=False)))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_jobs_do_not_grow_with_columns(spark):
    def jobs(width):
        group = f"profile-{width}"
        spark.sparkContext.setJobGroup(group, group)
        df = spark.range(20).select(*[(F.col("id") * i).cast("string").alias(f"c{i}") for i in range(width)])
        P.profile_columns({"x": df}).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    # with AQE every stage is a job of its own, and which empty stages it skips depends on timing
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert jobs(12) == jobs(2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(str(tmp_path / "t"))
    plan = _plan(generic.numeric_stats({"t": spark.read.parquet(str(tmp_path / "t")).select("a")}))
    assert "ReadSchema: struct<a:bigint>" in plan


def test_round_trip_of_the_profile(spark, messy, tmp_path):
    from colsight.sources import readers, writers

    profile = P.profile({"m": messy, "other": messy})
    writers.write_profiles(profile, str(tmp_path / "p"))
    back = readers.read_profiles(spark, str(tmp_path / "p"))
    assert {r["dataset"]: json.dumps(r.asDict(True), sort_keys=True) for r in back.select(*profile.columns).collect()} == {
        r["dataset"]: json.dumps(r.asDict(True), sort_keys=True) for r in profile.collect()
    }


def test_numbers_inside_strings(spark):
    """Weighted moments of distinct values are those of the cells."""
    import statistics

    cells = ["1000000001", "1000000002", "1000000002", " 7 ", "1.5", "2.5", "2.5", "x", None, "1e5"]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    got = {r["type"]: r for r in generic.numeric_stats({"t": df}).collect()}
    ints, reals = [1000000001, 1000000002, 1000000002, 7], [1.5, 2.5, 2.5]
    for kind, numbers in (("INTEGER (LONG)", ints), ("REAL", reals)):
        r = got[kind]
        assert (r["count"], float(r["max_value"]), float(r["min_value"])) == (len(numbers), max(numbers), min(numbers))
        assert r["mean"] == pytest.approx(statistics.mean(numbers)) and r["stddev"] == pytest.approx(statistics.stdev(numbers))
