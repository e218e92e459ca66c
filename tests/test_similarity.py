import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from colsight.functions.text import char_ngrams
from colsight.operators import components as K, similarity as Z


def _bag(text):
    return Counter(text[i : i + 3] for i in range(len(text) - 2))


def _score(a, b, metric):
    x, y = _bag(a), _bag(b)
    if metric == "jaccard":
        union = len(set(x) | set(y))
        return len(set(x) & set(y)) / union if union else 0.0
    norm = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    return sum(x[g] * y[g] for g in x) / norm if norm else 0.0


def _brute(texts, metric, least):
    names = sorted(set(texts))
    pairs = {(a, b): _score(a, b, metric) for i, a in enumerate(names) for b in names[i + 1 :]}
    return {k: round(v, 9) for k, v in pairs.items() if v >= least}


def _found(spark, texts, metric, least, staged):
    items = spark.createDataFrame([(t,) for t in sorted(set(texts))], "item string")
    pairs = Z.similar_pairs(items, char_ngrams(F.col("item")), metric, least, staged=staged)
    return {(r["a"], r["b"]): round(r["score"], 9) for r in pairs.collect()}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=12), min_size=2, max_size=25), st.sampled_from([0.31, 0.57, 0.83, 1.0]))
@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_pairs_are_all_found(spark, metric, texts, least):
    assert _found(spark, texts, metric, least, staged=False) == _brute(texts, metric, least)


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_hot_gram(spark, metric):
    """Every name shares grams with every other; only close ones come out, all of them."""
    names = [f"column_{i % 40}_{'x' * (i % 7)}_{i}" for i in range(120)]
    assert _found(spark, names, metric, 0.8, staged=True) == _brute(names, metric, 0.8)


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_pairs_are_scored_in_their_row(spark, metric):
    """Bags are not dealt out gram by gram for the pairs, and items that are texts are not shuffled as keys."""
    items = spark.createDataFrame([(f"name {i} of {'many ' * 20}",) for i in range(60)], "item string")
    pairs = Z.similar_pairs(items, char_ngrams(F.col("item")), metric, 0.8)
    assert pairs.count() > 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "gram" not in plan and "hashpartitioning(item" not in plan


@pytest.mark.parametrize("few", [0, 2, 100])
def test_repeated_grams(spark, monkeypatch, few):
    """Products of counts, looked up or met by sorting."""
    monkeypatch.setattr(Z, "FEW_REPEATS", few)
    texts = ["ab" * 9, "ab" * 5 + "cab", "abc" * 4, "abcabcx", "aaaa", "aaaaaaaaab", "xyz", "bca" * 3 + "aaaa"]
    assert _found(spark, texts, "cosine", 0.1, staged=True) == _brute(texts, "cosine", 0.1)


@pytest.mark.parametrize("staged", [True, False])
def test_items_of_several_rows(spark, staged):
    """Rows of one item are one bag; rows without an item pair nobody."""
    rows = [(1, "abcdef"), (1, "abcxyz"), (2, "abcdef"), (3, "abcxyz"), (3, "abcdef"), (None, "abcdef"), (4, None), (5, "ab")]
    items = spark.createDataFrame(rows, "item bigint, text string")
    found = Z.similar_pairs(items, char_ngrams(F.col("text")), "cosine", 0.5, staged=staged).collect()
    bags = {1: _bag("abcdef") + _bag("abcxyz"), 2: _bag("abcdef"), 3: _bag("abcdef") + _bag("abcxyz")}
    norm = {k: math.sqrt(sum(v * v for v in b.values())) for k, b in bags.items()}
    wanted = {(a, b): sum(bags[a][g] * bags[b][g] for g in bags[a]) / norm[a] / norm[b] for a, b in ((1, 2), (1, 3), (2, 3))}
    assert {(r.a, r.b): round(r.score, 9) for r in found} == {k: round(v, 9) for k, v in wanted.items()}


def test_hot_gram_is_spread(spark):
    """One gram in all items: its pairs come out of many tasks, each pair once."""
    rows = [(i, "hot", 400, 1, 3, 2, 3) for i in range(400)]
    prefixes = spark.createDataFrame(rows, "item int, gram string, df bigint, n bigint, rest bigint, left bigint, whole bigint")
    for metric in ("cosine", "jaccard"):
        met = Z._candidates(prefixes, metric, 0.5, salt_rows=20)
        assert met.count() == met.distinct().count() == 400 * 399 // 2
    joined = prefixes.select("gram", F.pmod(F.xxhash64("item"), F.lit(20)).alias("salt")).repartition(16, "gram", "salt")
    assert joined.select(F.spark_partition_id()).distinct().count() > 4


def test_arguments(spark):
    items = spark.createDataFrame([("a",)], "item string")
    for metric, least in (("other", 0.5), ("cosine", 0.0), ("cosine", 1.5)):
        with pytest.raises(ValueError):
            Z.similar_pairs(items, char_ngrams(F.col("item")), metric, least)


def test_copies_collapse(spark, rows):
    """A third of the texts are the same one."""
    data = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(60)]
    kept, copies = Z.representatives(spark.createDataFrame(data, "item bigint, text string"))
    assert kept.count() == 41
    assert rows(copies) == sorted(((i, 0 if i % 3 == 0 else i) for i in range(60)), key=repr)


def _union_find(edges, items):
    parent = {i: i for i in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {i: root(i) for i in items}


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=30))
def test_components(spark, edges):
    items = list(range(31))
    got = K.components(
        spark.createDataFrame(edges, "a int, b int"), spark.createDataFrame([(i,) for i in items], "item int")
    )
    assert {r["item"]: r["cluster_id"] for r in got.collect()} == _union_find(edges, items)


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(64)]
    star = [(100, 200 + i) for i in range(50)]
    got = {r["item"]: r["cluster_id"] for r in K.components(spark.createDataFrame(chain + star, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(65)}, 100: 100, **{200 + i: 100 for i in range(50)}}


def test_cluster_lists(spark, rows):
    clusters = spark.createDataFrame([("PREM_A", "k"), ("B", "k"), ("C", "z")], "item string, cluster_id string")
    chosen = spark.createDataFrame([("k", "location_type")], "cluster_id string, semantic_type string")
    assert rows(K.cluster_lists(clusters, chosen)) == [("location_type", "B"), ("location_type", "PREM_A")]
    assert rows(K.cluster_lists(clusters, chosen, contains="PREM")) == [("location_type", "PREM_A")]


def test_minhash(spark):
    texts = ["hello world", "héllo😀", "ab", "hello worlds"]
    items = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    got = {r["item"]: tuple(r)[1:] for r in Z.minhash(items, char_ngrams(F.col("text")), n_hashes=3).collect()}
    p = Z.MINHASH_PRIME

    def number(gram):
        x = 0
        for ch in gram:
            x = (x * Z.CODE_POINTS + ord(ch)) % p
        return x

    for i, t in enumerate(texts):
        xs = [number(g) for g in _bag(t)]
        want = tuple(min((a * x + b) % p for x in xs) if xs else None for a, b in Z.minhash_family(3))
        assert got[i] == want
