"""Phrases by the trie and terms by their rarest n-gram, against plain code."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from colsight.operators import phrases as X
from colsight.plans.staging import release

KINDS = ["GPE", "PERSON", "ORG"]


def plain_counts(value, phrases):
    found, at, words = [0] * len(KINDS), 0, [w for w in re.split(r"[^\w]+", value) if w]
    table = {}
    for label, term in phrases:
        table.setdefault(tuple(w for w in re.split(r"[^\w]+", term) if w), set()).add(label)
    table.pop((), None)
    while at < len(words):
        best = max((len(t) for t in table if tuple(words[at : at + len(t)]) == t), default=0)
        for label in table.get(tuple(words[at : at + best]), ()):
            if label in KINDS:
                found[KINDS.index(label)] += 1
        at += best or 1
    return tuple(found)


def test_names_in_a_value(spark):
    phrases = [("PERSON", "JOHN SMITH"), ("GPE", "ALBANY"), ("GPE", "ALBANY NY"), ("GPE", "NEW YORK"), ("ORG", "NEW YORK TIMES"), ("PERSON", "SMITH"), ("ORG", "SMITH"), ("GPE", ""), ("GPE", ", "), ("OTHER", "JOHN")]
    values = ["JOHN SMITH, ALBANY NY", "SMITH JOHN", "NEW YORK TIMES SQUARE, NEW YORK", "ALBANY ALBANY NY", "JOHNSMITH", "", None, "NY", "NEW NEW YORK", "JOHN  SMITH--SMITH"]
    got = {r.val: tuple(r)[1:] for r in X.phrase_counts(spark.createDataFrame([(v,) for v in values], "val string"), spark.createDataFrame(phrases, "label string, term string"), KINDS).collect()}
    assert got == {v: c for v in values if v and any(c := plain_counts(v, [p for p in phrases if p[0] in KINDS]))}
    assert got["JOHN SMITH, ALBANY NY"] == (1, 1, 0)
    release()


def test_random_phrases(spark):
    rnd = random.Random(5)
    words = list("abcdef")
    phrases = [(rnd.choice(KINDS), " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))) for _ in range(25)]
    values = list({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(150)})
    got = {r.val: tuple(r)[1:] for r in X.phrase_counts(spark.createDataFrame([(v,) for v in values], "val string"), spark.createDataFrame(phrases, "label string, term string"), KINDS).collect()}
    assert got == {v: c for v in values if any(c := plain_counts(v, phrases))}
    assert X.phrase_counts(spark.createDataFrame([("a",)], "val string"), spark.createDataFrame([], "label string, term string"), KINDS).count() == 0
    release()


def test_terms_equal_the_alternation(spark, rows):
    rnd = random.Random(6)
    letters = "ABC.(+*"
    keywords = [(rnd.choice("xy"), "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 5)))) for _ in range(60)] + [("x", "")]
    values = list({"".join(rnd.choice(letters + "  \t") for _ in range(rnd.randint(0, 14))) for _ in range(400)}) + [None]
    want = []
    for kind in "xy":
        pattern = re.compile("|".join(r"\s" + re.escape(t) for k, t in keywords if k == kind and t))
        want += [(v, kind) for v in values if v and pattern.search(v)]
    patterns = X.keyword_patterns(spark.createDataFrame(keywords, "semantic_type string, term string"))
    assert rows(X.term_matches(spark.createDataFrame([(v,) for v in values], "val string"), patterns)) == sorted(want, key=repr)
    assert X.term_matches(spark.createDataFrame([("a b",)], "val string"), patterns.limit(0)).count() == 0


def test_only_grams_with_a_pattern_are_sent(spark, rows):
    held = spark.createDataFrame([(f"v{i}", f"{i:03d}") for i in range(1000)], "val string, gram string")
    posted = spark.createDataFrame([("007",), ("500",), ("500",), ("zzz",)], "gram string")
    sent = rows(X.sent_grams(held, posted))
    assert {("v7", "007"), ("v500", "500")} <= set(sent) and len(sent) < 20
    assert X.sent_grams(held, posted.limit(0)).count() == 0
    assert X.sent_grams(held, held).count() == 1000
    release()


def test_time_is_nearly_flat_in_the_terms(spark):
    values = spark.range(20_000).select(F.concat(F.lit("sold to TERM"), F.col("id").cast("string"), F.lit(" here")).alias("val"))
    took = {}
    for n in (500, 10_000, 500, 10_000):
        keywords = spark.range(n).select(F.lit("k").alias("semantic_type"), F.concat(F.lit("TERM"), (F.col("id") * 7).cast("string"), F.lit(" HERE"), F.col("id").cast("string")).alias("term"))
        start = time.time()
        X.term_matches(values, X.keyword_patterns(keywords)).count()
        took[n] = time.time() - start
    assert took[10_000] < 4 * took[500] + 2  # twenty times the terms


def test_a_value_meets_few_terms(spark, monkeypatch):
    """Numbered names share all their runs of three digits; a value is sent to its own name's pattern and hardly any else's."""
    keywords = spark.range(3000).select(F.lit("k").alias("semantic_type"), F.format_string("Name#%09d", F.col("id") * 7919).alias("term"))
    values = spark.range(3000).select(F.format_string("sold to Name#%09d", F.col("id") * 7919).alias("val"))
    sent, plain = [], X.sent_grams
    monkeypatch.setattr(X, "sent_grams", lambda *a: sent.append(plain(*a)) or sent[-1])
    assert X.term_matches(values, X.keyword_patterns(keywords)).count() == 3000
    posted = keywords.select(F.col("term").alias("gram"))
    assert sent[-1].count() < 4000 and sent[-1].join(posted, "gram").count() == 3000
    release()


@pytest.mark.parametrize("n", [1, 2, 8])
def test_terms_of_many_lengths(spark, rows, n):
    """Terms are posted under themselves or a part of them."""
    rnd = random.Random(7)
    keywords = [("k", "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 14)))) for _ in range(40)]
    values = list({"".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 30))) for _ in range(200)} | {"\U0001f600 a", "é b\U0001f600"})
    want = [(v, "k") for v in values if any(re.search(r"\s" + t, v) for _, t in keywords)]
    patterns = X.keyword_patterns(spark.createDataFrame(keywords, "semantic_type string, term string"))
    assert rows(X.term_matches(spark.createDataFrame([(v,) for v in values], "val string"), patterns, n)) == sorted(want, key=repr)
    assert X._gram_lengths([5, 1, 9, 3, 7], 2) == [1, 5] and X._gram_lengths([4, 2], 8) == [2, 4]
    release()
