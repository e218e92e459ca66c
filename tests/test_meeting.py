"""Pairs scored in the places where they meet, against plain code."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from colsight.functions.text import char_ngrams
from colsight.operators import meeting as X, minindex as I, similarity as Z
from colsight.plans.staging import release


def some(n=60, seed=2):
    rnd = random.Random(seed)
    bags = {i: {rnd.randrange(-40, 40): rnd.choice([1, 1, 2, 5]) for _ in range(rnd.randint(1, 25))} for i in range(100, 100 + n)}
    pairs = rnd.sample(list(combinations(bags, 2)), 900)
    return bags, pairs


def plain(x, y, metric):
    both = x.keys() & y.keys()
    if metric == "jaccard":
        return len(both) / len(x.keys() | y.keys())
    return sum(x[g] * y[g] for g in both) / (math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values())))


@pytest.mark.parametrize("rows_held", [5, 17, 2048])
@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_pairs_of_one_thick_group(spark, monkeypatch, metric, rows_held):
    """Places that are cut into cells, and such that aren't: each pair comes out once, with its score."""
    monkeypatch.setattr(X, "SLICE", rows_held)
    bags, pairs = some()
    rows = spark.createDataFrame([(i, sorted(b), [b[g] for g in sorted(b)]) for i, b in bags.items()], "item bigint, hashes array<bigint>, counts array<bigint>")
    got = X.judged(spark.createDataFrame(pairs, "a bigint, b bigint"), rows, X.scores(metric)).collect()
    assert len(got) == 900
    assert {(r.a, r.b): r.score for r in got} == pytest.approx({(a, b): plain(bags[a], bags[b], metric) for a, b in pairs})
    release()


def test_a_row_is_sent_once_to_a_group(spark):
    """All pairs of 40 near copies need 40 rows, not two for each pair."""
    placed, needed = X._cells(spark.createDataFrame(list(combinations(range(40), 2)) + [(50, 51)], "a bigint, b bigint"))
    assert placed.count() == 781 and needed.count() == 42
    release()


def test_documents_are_not_joined_to_their_pairs(spark, rows):
    """Few grams in common: pairs come from the index, and no pair carries a bag through a shuffle."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for _ in range(400)]
    texts = [(i, words[i // 2] + words[(i * 7) % 400][: 10 + i % 5]) for i in range(800)]
    items = spark.createDataFrame(texts, "item bigint, text string")
    grams = char_ngrams(F.col("text"), 6)
    pairs = Z.similar_pairs(items, grams, "jaccard", 0.5)
    lines = pairs._jdf.queryExecution().executedPlan().toString().split("\n")
    assert any("MapInArrow" in x for x in lines) and not any("Join" in x and "hashes_a" in x for x in lines)
    sets = {i: {t[k : k + 6] for k in range(len(t) - 5)} for i, t in texts}
    want = sorted((a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9)) for a, b in combinations(sets, 2) if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b]))
    assert len(want) > 300 and rows(pairs.withColumn("score", F.round("score", 9))) == sorted(want, key=repr)
    found = {(r.a, r.b): round(r.score, 9) for r in I.near_pairs(items, grams, 0.5).collect()}
    assert found.items() <= {(a, b): s for a, b, s in want}.items() and len(found) > 0.9 * len(want)
    release()


def test_grams_are_made_once(spark, rows):
    """They aren't made below the joins to see which items have any; items without are left out all the same."""
    items = spark.createDataFrame([(1, "abcabc"), (2, "ab"), (3, None), (4, ""), (None, "abc"), (5, "xyz"), (5, "xyz")], "item bigint, text string")
    bags = Z.packed_bags(items, char_ngrams(F.col("text")))
    assert rows(bags.select("item", F.array_sort("counts"))) == [(1, [1, 1, 2]), (5, [2])]
    plan = bags._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "regexp_extract_all" in line for line in plan.split("\n"))
    release()
