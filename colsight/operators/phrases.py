"""Known phrases inside longer values, and terms of large lists, found by joins.

`phrase_counts` holds a dictionary of phrases as a trie of words: a node is (parent, word), named by
a hash of its parent and its word. All places of a value walk the trie together, one join a word, and
only places still on a path of the trie go on. Of the phrases found at a place the longest counts;
from the left, each phrase starts behind the one before.

`term_matches` posts each pattern under one run of characters that any match must contain: the whole literal where
there are few lengths of literals, else a long part of it, the one that fewest literals have. A value meets the patterns
of the runs it holds and only then are they run. Runs of three characters wouldn't do: there are so few of them that
the meetings grow with values times patterns. A value is sent only under runs that two bitmaps of bounded size, of the
runs with a pattern, don't clear.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from colsight.functions.text import NOT_WORD
from colsight.operators import semantic as S
from colsight.plans.staging import stage
from colsight.rules import FEW_VALUES

MARKS = 1 << 18  # least bits of such a bitmap, 64 to a row
MOST_MARKS = 1 << 26

# --- phrases -----------------------------------------------------------------------------------------


def words(c: Column) -> Column:
    """Runs of letters, digits and underscores."""
    return F.filter(F.split(c, NOT_WORD), lambda w: w != "")


def _trie(phrases: DataFrame, kinds: list[str], depth: int) -> DataFrame:
    """(parent, word, node, mark, more): the trie's edges; bit i of mark is set where a phrase of kind i ends."""
    at = phrases.select(words(F.col("term")).alias("words"), reduce(lambda acc, i: F.when(F.col("label") == kinds[i], 1 << i).otherwise(acc), range(len(kinds)), F.lit(0)).alias("bit"))
    steps = None
    at = at.where((F.size("words") > 0) & (F.col("bit") > 0)).withColumn("parent", F.lit(0).cast("bigint"))
    for k in range(depth):  # the longest phrase's words
        word = F.get("words", F.lit(k))
        here = at.where(F.size("words") > k).withColumn("word", word).withColumn("node", F.xxhash64("parent", "word"))
        step = here.select("parent", "word", "node", F.when(F.size("words") == k + 1, F.col("bit")).otherwise(0).alias("bit"), (F.size("words") > k + 1).alias("more"))
        steps = step if steps is None else steps.unionByName(step)
        at = here.select("words", "bit", F.col("node").alias("parent"))
    return steps.groupBy("parent", "word", "node").agg(F.bit_or("bit").alias("mark"), F.max("more").alias("more"))


def phrase_counts(values: DataFrame, phrases: DataFrame, kinds: list[str]) -> DataFrame:
    """(val, n_<kind>...): how many phrases of each kind a distinct `val` of `values` holds, from the left and
    longest first, none overlapping. Values without any are left out.

    `phrases(label, term)`; a term of several kinds counts for each. The trie is as deep as the
    longest term has words, which is one number read by the driver; nothing else is.
    """
    depth = phrases.where(F.col("label").isin(kinds)).agg(F.max(F.size(words(F.col("term")))).alias("d")).first()["d"] or 0
    empty = values.sparkSession.createDataFrame([], ", ".join(["val string", *[f"n_{k} bigint" for k in kinds]]))
    if not depth:
        return empty
    trie = stage(_trie(phrases, kinds, depth))
    digest = F.unhex(F.md5("val")).alias("digest")
    texts = stage(values.select("val").where("val <> ''").distinct().select(digest, "val", words(F.col("val")).alias("words")))
    at = texts.select("digest", F.posexplode("words").alias("place", "word"), "words").select(
        "digest", "place", F.lit(0).cast("bigint").alias("parent"), F.slice("words", F.col("place") + 1, depth).alias("ahead")
    )
    ends = []
    for k in range(depth):
        here = at.withColumn("word", F.get("ahead", F.lit(k))).where("word IS NOT NULL").join(trie, ["parent", "word"])
        here = stage(here.select("digest", "place", "ahead", "node", "mark", "more"))
        ends.append(here.where("mark > 0").select("digest", "place", F.lit(k + 1).alias("length"), "mark"))
        at = here.where("more").select("digest", "place", F.col("node").alias("parent"), "ahead")
    longest = reduce(DataFrame.unionByName, ends).groupBy("digest", "place").agg(F.max(F.struct("length", "mark")).alias("m"))
    found = longest.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("place", "m.length", "m.mark"))).alias("found"))  # at most a value's words
    start = F.struct(F.lit(0).alias("free"), *[F.lit(0).cast("bigint").alias(f"n_{k}") for k in kinds])

    def step(acc: Column, x: Column) -> Column:
        taken = x["place"] >= acc["free"]
        counts = [(acc[f"n_{k}"] + F.when(taken & (x["mark"].bitwiseAND(1 << i) != 0), 1).otherwise(0)).cast("bigint").alias(f"n_{k}") for i, k in enumerate(kinds)]
        return F.struct(F.when(taken, x["place"] + x["length"]).otherwise(acc["free"]).alias("free"), *counts)

    summed = found.select("digest", F.aggregate("found", start, step).alias("c")).select("digest", *[f"c.n_{k}" for k in kinds])
    return texts.join(summed, "digest").select("val", *[f"n_{k}" for k in kinds])


def entity_share_within(vc: DataFrame, entities: DataFrame, gated: bool = False) -> DataFrame:
    """City or person by the names found anywhere in the values: as `semantic.entity_share`, which
    knows whole values only. A value's weight counts once for each name in it."""
    kinds = list(S.ENTITY_LABELS)
    found = phrase_counts(vc, entities, kinds).withColumnRenamed("val", "phrase_val")
    marked = vc.join(found, vc["val"] == found["phrase_val"], "left")
    weights = [F.coalesce(F.sum(F.col(f"n_{k}") * F.col("count")), F.lit(0)).cast("bigint").alias(f"w_{k}") for k in kinds]
    wide = marked.groupBy("column_id").agg(F.count(F.lit(1)).alias("n_values"), *weights)
    return S.entity_decision(wide, gated, FEW_VALUES)


# --- large term lists ----------------------------------------------------------------------------------


def keyword_patterns(keywords: DataFrame) -> DataFrame:
    """(kind, pattern, literal) of `keywords(semantic_type, term)`: the term after white space."""
    escaped = F.regexp_replace("term", r"([.\\+*?\[\](){}^$|/\-])", r"\\$1")
    return keywords.where("term <> ''").distinct().select(F.col("semantic_type").alias("kind"), F.concat(F.lit(r"\s"), escaped).alias("pattern"), F.col("term").alias("literal"))


def term_matches(values: DataFrame, patterns: DataFrame, n: int = 8) -> DataFrame:
    """(val, kind): kinds of which a pattern is found in a distinct `val` of `values`.

    `patterns(kind, pattern, literal)`: a Java pattern and a text that every match of it contains,
    not empty. Grams are of at most n lengths; with no more lengths of literals, each is posted under itself.
    """
    known = stage(patterns.where("literal <> ''").distinct())
    texts = values.select("val").where("val <> ''").distinct()
    lengths = _gram_lengths([r["k"] for r in known.select(F.length("literal").alias("k")).distinct().collect()], n)  # a number for each length of a term
    if not lengths:
        return known.select(F.col("literal").alias("val"), "kind")  # no row
    held = texts.select("val", F.explode(F.array_distinct(F.concat(*[_substrings("val", F.lit(k)) for k in lengths]))).alias("gram"))
    # the longest of the lengths that a literal has; a literal of such a length is its own only gram
    own = F.array_max(F.filter(F.array(*[F.lit(k) for k in lengths]), lambda k: k <= F.length("literal")))
    parts = known.select("literal").distinct().withColumn("gram", F.explode(F.array_distinct(_substrings("literal", own))))
    shared = F.count(F.lit(1)).over(Window.partitionBy("gram"))
    whole = F.col("gram") == F.col("literal")
    rarest = parts.where(~whole).withColumn("n", shared).groupBy("literal").agg(F.min(F.struct("n", "gram")).alias("r")).select("literal", F.col("r.gram").alias("gram"))
    posted = stage(known.join(rarest.unionByName(parts.where(whole)), "literal"))
    n_marks, wanted = MARKS, min(16 * posted.count(), MOST_MARKS)
    while n_marks < wanted:
        n_marks *= 2
    sent = held
    for seed in (0, 1):
        sent = sent_grams(sent, posted, n_marks, seed)
    met = sent.join(posted, "gram").where(F.contains("val", "literal") & F.expr("val RLIKE pattern"))
    return met.select("val", "kind").distinct()


def _gram_lengths(lengths: list[int], n: int) -> list[int]:
    """At most `n` of the lengths of all terms, spread over them, the least among them."""
    ordered = sorted(lengths)
    few = min(n, len(ordered))
    return [ordered[i * len(ordered) // few] for i in range(few)]


def _substrings(c: str, k: Column) -> Column:
    """All runs of k characters."""
    runs = F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(F.col(c), i, k))
    return F.when(F.length(c) >= k, runs).otherwise(F.array().cast("array<string>"))


def sent_grams(held: DataFrame, posted: DataFrame, n_marks: int = MARKS, seed: int = 0) -> DataFrame:
    """Rows of `held(val, gram)` but those whose gram `posted(gram)` surely doesn't have; some of those may stay."""
    at = F.pmod(F.xxhash64("gram", F.lit(seed)), F.lit(n_marks))
    marks = posted.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
    marked = held.join(F.broadcast(stage(marks)), F.shiftright(at, 6) == F.col("word"))
    return marked.where(F.getbit("bits", (at % 64).cast("int")) == 1).select("val", "gram")


def detect_terms(vc: DataFrame, keywords: DataFrame) -> DataFrame:
    """(column_id, semantic_type, weight, share): the weight of values with a term of a list after white space."""
    found = term_matches(vc, keyword_patterns(keywords)).withColumnsRenamed({"val": "term_val", "kind": "semantic_type"})
    total = vc.groupBy("column_id").agg(S.total_weight().alias("total"))
    hit = vc.join(found, vc["val"] == found["term_val"]).groupBy("column_id", "semantic_type").agg(S.total_weight().alias("weight"))
    return hit.join(total, "column_id").select("column_id", "semantic_type", "weight", S.ratio(F.col("weight"), F.col("total")).alias("share"))
