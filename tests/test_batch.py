"""Batches that resume, merged profiles, and the min-hash index."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from colsight.functions.text import split_words
from colsight.operators import minindex as X, similarity as Z
from colsight.plans import batch, merge, profile as P
from colsight.plans.staging import release, stage


def files(tmp_path, names):
    for i, n in enumerate(names):
        (tmp_path / f"{n}.tsv").write_text(f"a\tb\n{i}\tx\n{i + 1}\ty\n")


def states(ledger):
    return {r.dataset: (r.state, r.error is not None) for r in ledger.collect()}


def test_batch_resumes_and_quarantines(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    files(folder, ["t1", "t2", "t3", "t4"])
    (folder / "bad.tsv.gz").write_bytes(b"no gzip at all")
    catalog = spark.createDataFrame([(n,) for n in ("t1", "t2", "bad", "t3", "gone", "t1", "")], "dataset string")
    want = {"t1": ("done", False), "t2": ("done", False), "t3": ("done", False), "bad": ("failed", True), "gone": ("failed", True)}
    assert states(batch.profile_catalog(spark, catalog, str(folder), out, size=4)) == want
    first = {p.name for p in (tmp_path / "out" / "profiles").iterdir()}
    assert states(batch.profile_catalog(spark, catalog, str(folder), out)) == want
    assert {p.name for p in (tmp_path / "out" / "profiles").iterdir()} == first
    # what a run that died has left isn't read
    P.profile_folder(spark, str(folder / "t4.tsv")).write.json(f"{out}/profiles/slice=left")
    assert sorted(r.dataset for r in batch.read_batch(spark, out).collect()) == ["t1", "t2", "t3"]
    # a mended table is done on demand, new ones always
    files(folder, ["gone"])
    more = catalog.union(spark.createDataFrame([("t4",)], "dataset string"))
    batch.profile_catalog(spark, more, str(folder), out, retry=True)
    assert sorted(r.dataset for r in batch.read_batch(spark, out).collect()) == ["gone", "t1", "t2", "t3", "t4"]
    assert batch.read_batch(spark, str(tmp_path / "none")).count() == 0
    release()


def test_merged_profile_is_the_profile_of_all_rows(spark, rows):
    a = [("1", "5", "x", "true", "2015-02-03"), ("2", None, "", "false", "2015-02-04")]
    b = [("2.5", "7", "3", "no", "2015-02-03 10:00:00"), ("1", "7", "x", None, None)]
    schema = "number string, whole string, text string, flag string, day string"
    parts = [spark.createDataFrame(r, schema) for r in (a, b)]
    merged = merge.merge_values(*[merge.value_state({"t": p}) for p in parts])
    whole = merge.value_state({"t": parts[0].unionByName(parts[1])})
    got, want = (P.flatten(merge.profile_state(s)) for s in (merged, whole))
    assert rows(got) == rows(want)
    types = {(r.column_name, r.type) for r in got.collect()}
    assert {("number", "REAL"), ("whole", "INTEGER (LONG)"), ("flag", "TEXT"), ("day", "DATE/TIME")} <= types
    release()


def test_values_of_one_column_are_typed_in_many_tasks(spark):
    state = stage(spark.range(4000).selectExpr("'t' AS dataset", "'c' AS column_name", "CAST(id AS STRING) AS val", "id + 1 AS count"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in merge.typed_values(state).groupBy(F.spark_partition_id()).count().collect()]
        doubled = merge.typed_values(stage(state.withColumn("val", F.concat("val", F.lit(".0"))).unionByName(state.withColumn("val", F.concat("val", F.lit(".00"))))))
        assert doubled.agg(F.count("val"), F.count_distinct("val"), F.sum("count")).first()[:] == (4000, 4000, 4000 * 4001)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 4000 and max(sizes) < 2000
    release()


def test_merged_states(spark):
    rnd = random.Random(8)
    values = [rnd.gauss(1e6, 3) if rnd.random() < 0.9 else None for _ in range(3000)]
    names = [f"n{rnd.randrange(500)}" for _ in values]
    parts = [spark.createDataFrame(list(zip(values[i::3], names[i::3])), "x double, s string") for i in range(3)] + [spark.createDataFrame([(None, "zz")], "x double, s string")]
    out = {r.column_name: r for r in merge.read_columns(merge.merge_columns(*[merge.column_states({"t": p}) for p in parts])).collect()}
    filled = [v for v in values if v is not None]
    x, s = out["x"], out["s"]
    assert (x.non_empty, x.empty, x.low, x.high) == (len(filled), len(values) - len(filled) + 1, min(filled), max(filled))
    assert x.mean == pytest.approx(statistics.fmean(filled)) and x.stddev == pytest.approx(statistics.stdev(filled), rel=1e-6)
    assert (s.least, s.greatest, s.mean) == (min(names), "zz", None)
    assert s.about_distinct == pytest.approx(len(set(names)) + 1, rel=0.03)


def test_index_of_min_hashes(spark):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(3000)}" for _ in range(120)]
    data = [(0, "")]
    for i in range(1, 240):  # one large family, some small ones, some alone
        words = list(base) if i % 3 == 0 else [f"w{rnd.randrange(3000)}" for _ in range(60)] if i % 3 == 1 or i < 6 else data[i - 3][1].split()
        for _ in range(rnd.randrange(12)):
            words[rnd.randrange(len(words))] = f"v{rnd.randrange(10_000)}"
        data.append((i, " ".join(words)))
    items = spark.createDataFrame(data, "item int, text string")
    grams = split_words(F.col("text"))
    exact = {(r.a, r.b): r.score for r in Z.similar_pairs(items, grams, "jaccard", 0.6).collect()}
    for salt_rows in (1000, 7):
        found = {(r.a, r.b): r for r in X.near_pairs(items, grams, 0.6, salt_rows=salt_rows).collect()}
        assert set(found) <= set(exact)
        assert len(found) >= 0.95 * len(exact) > 500
        assert all(abs(r.score - exact[p]) < 1e-9 and abs(r.estimate - r.score) < 0.35 for p, r in found.items())
    release()
