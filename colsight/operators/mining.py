"""Keyword lists from the values of known columns; frequent word sets."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight import rules as R
from colsight.functions.text import clean_words, split_words, sql_text
from colsight.operators.ranking import top_per_group
from colsight.plans.staging import stage


def column_words(vc: DataFrame, weighted: bool = False, keep_dash: Column | None = None) -> DataFrame:
    """(column_id, word, count): words of all distinct values, optionally by their weight."""
    cleaned = clean_words(F.col("val"))
    if keep_dash is not None:
        cleaned = F.when(keep_dash, clean_words(F.col("val"), keep_dash=True)).otherwise(cleaned)
    extra = [c for c in vc.columns if c not in ("val", "count")]
    words = vc.select(*extra, "count", F.explode(split_words(cleaned)).alias("word"))
    amount = F.sum("count") if weighted else F.count(F.lit(1))
    return words.groupBy(*extra, "word").agg(amount.cast("bigint").alias("count"))


def top_words(vc: DataFrame, n: int, weighted: bool = False) -> DataFrame:
    """(column_id, rank, word, count): the n most frequent words per column, ties by word."""
    ranked = top_per_group(column_words(vc, weighted), ["column_id"], [F.desc("count"), F.asc("word")], n)
    return ranked.select("column_id", "rank", "word", "count")


def _removed(spark: SparkSession, removals: Mapping[str, Iterable[str]]) -> DataFrame | None:
    rows = ", ".join(f"({sql_text(k)}, {sql_text(w)})" for k, ws in removals.items() for w in ws)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(semantic_type, word)") if rows else None


def merge_keywords(
    words: DataFrame,
    stop_words: Iterable[str] = R.STOP_WORDS,
    removals: Mapping[str, Iterable[str]] = R.REMOVED_WORDS,
    shortest: Mapping[str, int] = R.SHORTEST_WORD,
) -> DataFrame:
    """(semantic_type, term): distinct words without stop words, removals and short ones, upper case."""
    merged = words.select("semantic_type", F.lower("word").alias("word")).distinct()
    merged = merged.where(~F.col("word").isin(list(stop_words)))
    removed = _removed(words.sparkSession, removals)
    if removed is not None:
        merged = merged.join(removed, ["semantic_type", "word"], "left_anti")
    for kind, length in shortest.items():
        merged = merged.where((F.col("semantic_type") != kind) | (F.char_length("word") >= length))
    return merged.select("semantic_type", F.upper("word").alias("term"))


def mine_keywords(
    vc: DataFrame,
    column_types: DataFrame,
    top_n: Mapping[str, int] = R.TOP_WORDS,
    stop_words: Iterable[str] = R.STOP_WORDS,
    removals: Mapping[str, Iterable[str]] = R.REMOVED_WORDS,
    shortest: Mapping[str, int] = R.SHORTEST_WORD,
    weighted: bool = False,
) -> DataFrame:
    """(semantic_type, term): the most frequent words of every column of a type, merged.

    One job for all types: `column_types(column_id, semantic_type)` says which columns feed
    which list. The rank is limited by the largest n first, a constant, so that tasks drop
    the rest before the shuffle, and by each type's own n after it.
    """
    kinds = list(top_n)
    typed = vc.join(column_types.where(F.col("semantic_type").isin(kinds)), "column_id")
    words = column_words(typed, weighted, F.col("semantic_type").isin(list(R.KEEPS_DASH)))
    ranked = top_per_group(
        words, ["semantic_type", "column_id"], [F.desc("count"), F.asc("word")], max(top_n.values())
    )
    own_limit = F.expr("CASE semantic_type " + " ".join(f"WHEN {sql_text(k)} THEN {n}" for k, n in top_n.items()) + " END")
    return merge_keywords(ranked.where(F.col("rank") <= own_limit), stop_words, removals, shortest)


def keyword_regex(keywords: DataFrame) -> DataFrame:
    """(semantic_type, pattern): terms as alternatives after a blank, escaped, in order.

    A pattern is one string, so this is meant for keyword lists, not for raw words.
    """
    escaped = F.regexp_replace("term", r"([.\\+*?\[\](){}^$|/\-])", r"\\$1")
    pattern = F.concat(F.lit("\\s"), escaped)
    return (
        keywords.where(F.col("term") != "")
        .distinct()
        .groupBy("semantic_type")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("term", pattern.alias("p")))), lambda t: t["p"]), "|").alias("pattern"))
    )


def word_baskets(vc: DataFrame) -> DataFrame:
    """(items): the distinct words of each value."""
    return vc.select(F.array_distinct(F.filter(F.split("val", r"\s+"), lambda w: w != "")).alias("items")).where(F.size("items") > 0)


BASKETS_OF_A_TASK = 500_000


def _growth(baskets: DataFrame, min_support: float, min_confidence: float):
    """The model, and what turns its numbers back into items.

    FP-growth keeps the baskets in memory, as many to a task as the input has partitions. So it gets
    them dealt out evenly, at most BASKETS_OF_A_TASK to a task, with the frequent items as small
    numbers; others can't be in a frequent set.
    """
    held = stage(baskets.select("items").where(F.col("items").isNotNull()))
    total = held.count()
    single = held.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    frequent = [r["item"] for r in single.where(F.col("n") >= math.ceil(min_support * total)).orderBy(F.desc("n"), "item").collect()]
    element = held.schema["items"].dataType.elementType
    words = F.array(*[F.lit(x) for x in frequent]).cast(held.schema["items"].dataType) if frequent else F.array().cast(held.schema["items"].dataType)
    number = F.lit(frequent.index(None) + 1) if None in frequent else F.lit(0)
    numbers = F.filter(F.transform("items", lambda x: F.when(x.isNull(), number).otherwise(F.array_position(words, x.cast(element)).cast("int"))), lambda c: c > 0)
    even = held.select(numbers.alias("items")).repartition(total // BASKETS_OF_A_TASK + 1)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(even)
    return model, lambda c: F.transform(c, lambda i: F.element_at(words, i))


def frequent_itemsets(baskets: DataFrame, min_support: float) -> DataFrame:
    """(items, freq): sets in at least `min_support` of the baskets, items in order.

    The frequent single items go through the driver; there are at most
    mean basket size / min_support of them, whatever the number of baskets.
    """
    model, named = _growth(baskets, min_support, 0.8)
    return model.freqItemsets.select(F.array_sort(named("items")).alias("items"), "freq")


def association_rules(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support)."""
    model, named = _growth(baskets, min_support, min_confidence)
    rules = model.associationRules
    return rules.select(F.array_sort(named("antecedent")).alias("antecedent"), named("consequent").alias("consequent"), "confidence", "lift", "support")


def apply_rules(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """(basket, consequent, confidence): what the rules add to each of `baskets(basket, items)`.

    A rule `(antecedent, consequent, confidence)` holds for a basket that has all of its antecedent;
    of several rules with one consequent the highest confidence stays, and what the basket already
    has isn't added. Consequents may be single or, as mined, arrays. Repeated items count once, null
    items not at all; a rule without antecedent says nothing of a basket and is left out.

    Baskets of the same items get the same answer, so each distinct set of items is looked up once. Each
    antecedent is posted with all it says under its rarest item, so a set meets only those whose rarest item
    it has, each once. A set's items travel with the item that is looked up, and containment is decided
    where they meet: what is shuffled after that are answers. Rarest first also keeps common items free of postings.
    """
    clean = stage(baskets.where(F.col("basket").isNotNull()).select("basket", F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull()))).alias("items")))
    said = rules
    if dict(rules.dtypes)["consequent"].startswith("array"):
        said = rules.select("antecedent", F.explode("consequent").alias("consequent"), "confidence")
    said = said.select(F.array_sort(F.array_distinct("antecedent")).alias("antecedent"), "consequent", "confidence").where(F.size("antecedent") > 0)
    said = said.groupBy("antecedent", "consequent").agg(F.max("confidence").alias("confidence"))
    said = stage(said.groupBy("antecedent").agg(F.collect_list(F.struct("consequent", "confidence")).alias("says")))
    parts = said.select("antecedent", F.explode("antecedent").alias("item"))
    frequency = clean.select(F.explode("items").alias("item")).join(parts.select("item").distinct(), "item", "left_semi").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    # an item that no basket has is the rarest of all, and its rule meets nobody
    rarest = parts.join(frequency, "item", "left").groupBy("antecedent").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "item")).alias("r"))
    posted = stage(said.join(rarest.select("antecedent", F.col("r.item").alias("item")), "antecedent"))
    met = clean.select("items").distinct().select("items", F.explode("items").alias("item")).join(posted, "item")
    whole = met.where(F.size(F.array_intersect("antecedent", "items")) == F.size("antecedent"))
    new = whole.select("items", F.inline(F.filter("says", lambda x: ~F.array_contains(F.col("items"), x["consequent"]))))
    best = new.groupBy("items", "consequent").agg(F.max("confidence").alias("confidence"))
    answers = stage(best.groupBy("items").agg(F.collect_list(F.struct("consequent", "confidence")).alias("says")))
    return clean.join(answers, "items").select("basket", F.inline("says")).groupBy("basket", "consequent").agg(F.max("confidence").alias("confidence"))
