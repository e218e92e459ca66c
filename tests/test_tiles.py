"""Pairs of items that share most of their grams, tile by tile, against plain code."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colsight.functions.text import char_ngrams
from colsight.operators import similarity as Z, tiles as X
from colsight.plans.staging import release
from tests.test_similarity import _brute


def some_names(n=140):
    rnd = random.Random(4)
    return sorted({f"{rnd.choice(['http', 'https'])}   {rnd.choice(['abab', 'site', 'other'])} example {rnd.choice(['net en', 'org'])} {rnd.randrange(400)}" for _ in range(n)} | {"ab", "abc", "aaaaaaa"})


def found(pairs):
    return {(r.a, r.b): round(r.score, 9) for r in pairs.collect()}


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_names_are_compared_without_a_join(spark, metric):
    """Pairs are neither shuffled nor joined, and all of them come out."""
    items = spark.createDataFrame([(x,) for x in some_names()], "item string")
    pairs = Z.similar_pairs(items, char_ngrams(F.col("item")), metric, 0.8)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    assert found(pairs) == _brute(some_names(), metric, 0.8)
    release()


@pytest.mark.parametrize("metric, least", [("cosine", 0.8), ("jaccard", 0.6), ("cosine", 0.05), ("jaccard", 1.0)])
@pytest.mark.parametrize("n_items", [1, 10_000, 60_000])
def test_tiles(spark, metric, least, n_items):
    """One tile, some and more than there are ranges."""
    items = spark.createDataFrame([(x,) for x in some_names()], "item string")
    bags = Z.packed_bags(items, char_ngrams(F.col("item")))
    assert found(X.tiled_pairs(bags, metric, least, n_items)) == _brute(some_names(), metric, least)


def test_items_with_few_grams_in_common_use_the_index(spark):
    few = spark.createDataFrame([(i, [i * 1000 + k for k in range(4)]) for i in range(2000)], "item bigint, hashes array<bigint>")
    many = spark.createDataFrame([(i, [k * (i % 5 + 1) for k in range(4)]) for i in range(2000)], "item bigint, hashes array<bigint>")
    assert X.share_most(few) == (False, 2000)
    assert X.share_most(many) == (True, 2000)
    assert X.share_most(many.limit(0)) == (False, 0)


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_blocks(monkeypatch, metric):
    """A tile that meets itself in several blocks, with more grams than are held at a time, and counts beyond single precision."""
    monkeypatch.setattr(X, "BLOCK", 7)
    monkeypatch.setattr(X, "WIDTH", 3)
    monkeypatch.setattr(X, "ROWS", 5)
    rnd = random.Random(9)
    bags = [{g: rnd.choice([1, 1, 2, 9000]) for g in rnd.sample(range(-6, 6), rnd.randint(1, 9))} for _ in range(40)]
    table = pa.table({
        "key": [0] * 40, "tile": [0] * 40, "item": list(range(100, 140)),
        "hashes": pa.array([sorted(b) for b in bags], pa.list_(pa.int64())), "counts": pa.array([[b[g] for g in sorted(b)] for b in bags], pa.list_(pa.int64())),
    })
    got = {(a, b): s for part in X._tile_pairs(table, 1, metric, 0.6) for a, b, s in zip(*(c.to_pylist() for c in part.columns))}
    want = {}
    for i in range(40):
        for j in range(i + 1, 40):
            x, y = bags[i], bags[j]
            both = x.keys() & y.keys()
            score = len(both) / len(x.keys() | y.keys()) if metric == "jaccard" else sum(x[g] * y[g] for g in both) / (np.sqrt(sum(v * v for v in x.values())) * np.sqrt(sum(v * v for v in y.values())))
            if score >= 0.6:
                want[100 + i, 100 + j] = score
    assert got == pytest.approx(want) and len(want) > 5
