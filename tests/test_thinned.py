"""Edges that tasks drop before any is shuffled."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colsight.operators import components as K, forest as H
from colsight.plans.staging import release
from tests.test_forest import groups, kruskal


def dense(n=60, seed=3):
    rnd = random.Random(seed)
    pairs = [(f"{a:02d}é", f"{b:02d}é", rnd.choice([0.8, 0.85, 0.9])) for a in range(n) for b in range(a + 1, n) if a % 3 == b % 3]
    return rnd.sample(pairs, len(pairs))


@pytest.mark.parametrize("chunk, held", [(7, 1000), (100, 5), (1_000_000, 1_000_000)])
def test_chunks(monkeypatch, chunk, held):
    """Whatever a task takes at a time and keeps, the same items are connected and the same forest is left."""
    monkeypatch.setattr(K, "CHUNK", chunk)
    monkeypatch.setattr(K, "MOST_HELD", held)
    edges = dense()
    a, b, score = zip(*edges)
    items = sorted({*a, *b})
    batches = pa.table({"a": a, "b": b, "loss": [-x for x in score]}).to_batches(max_chunksize=13)
    left = [(r["a"], r["b"], -r["loss"]) for x in K.by_chunks(H._forest)(iter(batches)) for r in x.to_pylist()]
    assert kruskal(left) == kruskal(edges) and set(left) <= set(edges)
    stars = [(r["u"], r["v"]) for x in K.by_chunks(K._stars)(iter([x.select(["a", "b"]).rename_columns(["u", "v"]) for x in batches])) for r in x.to_pylist()]
    assert groups(items, stars) == groups(items, [e[:2] for e in edges])
    if held > len(items):
        assert len(left) == len(stars) == len(items) - 3


def test_tasks_drop_edges(spark, rows):
    edges = spark.createDataFrame(dense(), "a string, b string, score double").coalesce(2)
    assert K.thinned(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).count() <= 2 * 57
    assert H.thinned(edges.select("a", "b", (-F.col("score")).alias("loss"))).count() <= 2 * 57
    assert rows(H.spanning_forest(edges)) == sorted(kruskal(dense()), key=repr)
    assert {r.item: r.cluster_id for r in K.components(edges).collect()} == {f"{i:02d}é": f"{i % 3:02d}é" for i in range(60)}
    release()


def test_other_items_are_left(spark):
    """Items that tasks can't order as Spark does, and scores that may be null."""
    edges = spark.createDataFrame([((1, "a"), (1, "b")), ((1, "b"), (2, "a"))], "u struct<x: int, y: string>, v struct<x: int, y: string>")
    assert K.thinned(edges).count() == 2
    odd = spark.createDataFrame([(1, 2, None), (2, 3, -0.9), (1, 3, -0.8)], "a int, b int, loss double").coalesce(1)
    assert {(r.a, r.b) for r in H.thinned(odd).collect()} == {(1, 2), (2, 3)}
