"""Rules, word sets and n-gram counts on rows of their own."""

from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from colsight.functions.text import word_ngrams
from colsight.operators import mining as M, similarity as Z


def test_equal_baskets_are_looked_up_once(spark, rows, monkeypatch):
    """Rules meet distinct sets, not baskets, and nothing but answers is shuffled by basket."""
    staged, stage = [], M.stage
    monkeypatch.setattr(M, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    sets = [["a", "b", None], ["b", "a"], ["c"], ["a"], []]
    baskets = spark.createDataFrame([(i, sets[i % 5]) for i in range(500)] + [(None, ["a"])], "basket int, items array<string>")
    rules = spark.createDataFrame([(["a"], ["c"], 0.5), (["a", "b"], ["c"], 0.75), (["c"], ["c"], 1.0), (["z"], ["a"], 1.0), ([], ["a"], 1.0)], "antecedent array<string>, consequent array<string>, confidence double")
    got = rows(M.apply_rules(baskets, rules))
    assert got == sorted([(i, "c", 0.75 if i % 5 < 2 else 0.5) for i in range(500) if i % 5 in (0, 1, 3)], key=repr)
    assert [x.count() for x in staged if x.columns == ["items", "says"]] == [2]


def test_growth_gets_numbers_in_even_parts(spark, rows, monkeypatch):
    given = []
    fit = M.FPGrowth.fit
    monkeypatch.setattr(M.FPGrowth, "fit", lambda self, df: given.append(df) or fit(self, df))
    monkeypatch.setattr(M, "BASKETS_OF_A_TASK", 10)
    data = [["x", None, f"rare{i}"] if i % 3 else ["x", "y"] for i in range(39)] + [[]]
    got = rows(M.frequent_itemsets(spark.createDataFrame([(x,) for x in data] + [(None,)], "items array<string>"), 0.3))
    want = Counter(tuple(sorted(c, key=lambda x: (x is None, x))) for b in data for k in (1, 2, 3) for c in combinations(b, k))
    assert {tuple(i): n for i, n in got} == {k: n for k, n in want.items() if n >= 12}
    assert given[0].dtypes == [("items", "array<int>")] and given[0].rdd.getNumPartitions() == 5


def test_gram_counts(spark, rows):
    """Repeated grams, items in several rows and items without a key; grams are shuffled once."""
    data = [(1, "a b c d a b c d a"), (2, "a b c d"), (2, "a b c d e"), (None, "b c d e"), (None, "b c d e"), (3, None), (4, "a b")]
    items = spark.createDataFrame(data, "item int, text string")
    got = Z.gram_counts(items, word_ngrams(F.col("text")))
    old = Z.gram_bags(items, word_ngrams(F.col("text"))).groupBy("gram").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("n"))
    assert rows(got) == rows(old) and ("a b c d", 2, 4) in rows(got)
    single = Z.gram_counts(items.where("item IN (1, 4)"), word_ngrams(F.col("text")))
    assert single._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
