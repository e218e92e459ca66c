"""Spanning forests and their cuts against plain code."""

import random
from statistics import mean, stdev

import pytest

from colsight.operators import forest as H
from colsight.plans.staging import release


def kruskal(edges):
    best = {}
    for a, b, score in edges:
        if a != b:
            key = (min(a, b), max(a, b))
            best[key] = max(best.get(key, score), score)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    out = []
    for (a, b), score in sorted(best.items(), key=lambda e: (-e[1], e[0])):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b, score))
    return sorted(out)


def groups(items, edges):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in items}


def some(seed, n=40, m=90):
    rnd = random.Random(seed)
    return [(rnd.randrange(n), rnd.randrange(n), rnd.choice([0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) for _ in range(m)]


SCHEMA = "a int, b int, score double"


@pytest.mark.parametrize("edges", [[], [(3, 3, 1.0)], some(1), some(2, 12, 60), [(i, i + 1, 1 - i / 100) for i in range(40)], [(0, i, 0.9) for i in range(1, 30)] + [(1, 0, 0.95)]])
def test_forest(spark, rows, edges):
    assert rows(H.spanning_forest(spark.createDataFrame(edges, SCHEMA))) == sorted(kruskal(edges), key=repr)
    release()


def test_cuts_are_components_at_each_level(spark):
    edges = some(3)
    items = list(range(45))
    forest = H.spanning_forest(spark.createDataFrame(edges, SCHEMA))
    levels = (0.55, 0.8, 0.95)
    got = {(r.item, r.level): r.cluster_id for r in H.cuts(forest, spark.createDataFrame([(i,) for i in items], "item int"), levels).collect()}
    assert got == {(i, t): c for t in levels for i, c in groups(items, [(a, b) for a, b, s in edges if s >= t]).items()}
    release()


def test_inconsistent_edges(spark):
    edges = [(1, 2, 0.95), (2, 3, 0.94), (1, 4, 0.93), (4, 5, 0.6), (5, 6, 0.92), (5, 7, 0.95), (8, 9, 0.5)]
    forest = spark.createDataFrame(edges, SCHEMA)
    got = {(r.a, r.b): (r.neighbours, r.coefficient) for r in H.inconsistency(forest).collect()}
    for a, b, score in edges:
        near = [1 - s for x, y, s in edges if {x, y} & {a, b} and (x, y) != (a, b)]
        n, c = got[a, b]
        assert n == len(near)
        assert c is None if n < 2 else c == pytest.approx((1 - score - mean(near)) / stdev(near), abs=1e-6)
    cut = {r.item: r.cluster_id for r in H.consistent_groups(forest, spark.createDataFrame([(i,) for i in range(1, 11)], "item int"), most=2.0).collect()}
    assert cut == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 10: 10}
    release()
