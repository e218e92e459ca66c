"""Similar names and texts by their n-grams, without comparing everything with everything.

Exact: an inverted index over each item's *prefix*, its rarest grams. Two items that reach
the score must share a gram of both prefixes, early enough to reach the score with what follows.
From the prefix grams a pair shares follows the most it can still score; only pairs for which
that is enough are scored on their full bags. Items that share most of their grams, which an index
doesn't tell apart, are compared tile by tile (`tiles`), with the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from colsight.functions.text import let
from colsight.operators.meeting import judged, scores
from colsight.operators.tiles import share_most, tiled_pairs
from colsight.plans.staging import stage

# slack for the bounds only; the score itself is compared exactly
EPSILON = 1e-9


def representatives(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One item per distinct text, and `(item, representative)` for all items.

    Copies are found by digest, so texts aren't shuffled as keys. The mapping is read off
    a join with one row per text, which splits where one text fills a large share of items.
    """
    keyed = items.withColumn("digest", F.sha2("text", 256))
    first = keyed.groupBy("digest").agg(F.min("item").alias("representative"))
    copies = keyed.select("item", "digest").join(first, "digest").select("item", "representative")
    kept = items.join(first.select(F.col("representative").alias("item")), "item", "left_semi")
    return kept, copies


def gram_bags(items: DataFrame, grams: Column) -> DataFrame:
    """(item, gram, n) from `items(item, ...)`."""
    return items.select("item", F.explode(grams).alias("gram")).groupBy("item", "gram").agg(F.count(F.lit(1)).alias("n"))


def gram_counts(items: DataFrame, grams: Column) -> DataFrame:
    """(gram, items, n) from `items(item, ...)`: how many items have the gram and how often it occurs.

    An item's grams are sorted inside its row, where the first of equal ones is marked, so only grams are
    shuffled, combined on the map side. Items that come in several rows are grouped before that.
    """

    def marked(ordered: Column) -> Column:
        return F.transform(ordered, lambda g, i: F.struct(g.alias("gram"), (F.coalesce(F.get(ordered, i - 1), F.lit("")) != g).cast("bigint").alias("items"), F.lit(1).cast("bigint").alias("n")))

    repeated = stage(items.groupBy("item").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("item"))
    same = items["item"].eqNullSafe(repeated["item"])
    counts = items.join(repeated, same, "left_anti").select(F.inline(let(F.array_sort(grams), marked)))
    if not repeated.isEmpty():
        bags = gram_bags(items.join(repeated, same, "left_semi"), grams)
        counts = counts.unionByName(bags.select("gram", F.lit(1).cast("bigint").alias("items"), "n"))
    return counts.groupBy("gram").agg(F.sum("items").alias("items"), F.sum("n").alias("n"))


def packed_bags(items: DataFrame, grams: Column) -> DataFrame:
    """(item, hashes, counts) from `items(item, ...)`: an item's distinct grams as 64-bit hashes, ascending, and how
    often each occurs. Made inside the row; only items that come in several rows are grouped. Items without grams
    or without a name pair nobody and are left out.

    Two grams of a pair of items with 3,000 grams each have the same hash once in some 10^12 pairs.
    """

    def counted(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i - 1) != F.get(ordered, i)))
        return let(starts, lambda at: F.struct(
            F.transform(at, lambda i: F.get(ordered, i)).alias("hashes"),
            F.transform(at, lambda i, j: (F.coalesce(F.get(at, j + 1), F.size(ordered)) - i).cast("bigint")).alias("counts"),
        ))

    named = items.where("item IS NOT NULL")
    repeated = stage(named.groupBy("item").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("item"))
    hashed = F.transform(grams, lambda g: F.xxhash64(g)).alias("hashes")
    rows = named.join(repeated, "item", "left_anti").select("item", hashed)
    if not repeated.isEmpty():
        several = named.join(repeated, "item", "left_semi").select("item", hashed)
        rows = rows.unionByName(several.groupBy("item").agg(F.flatten(F.collect_list("hashes")).alias("hashes")))
    # asked of what `inline` gives, or the grams would be made below the joins once more, only to see whether there are any
    return rows.select("item", F.inline(F.array(let(F.array_sort("hashes"), counted)))).where(F.size("hashes") > 0)


FEW_REPEATS = 100  # grams that occur more than once in an item: so many are looked up one by one, more are met by sorting


def in_common(metric: str) -> Column:
    """Shared grams of `hashes_a` and `hashes_b`, each counted once (jaccard) or as the product of its counts (cosine)."""
    once = F.size(F.array_intersect("hashes_a", "hashes_b")).cast("bigint")
    if metric == "jaccard":
        return once
    zero = F.lit(0).cast("bigint")

    def count(side: str, gram: Column) -> Column:
        return F.coalesce(F.get(f"counts_{side}", F.array_position(f"hashes_{side}", gram).cast("int") - 1), zero)

    def more(side: str, extra) -> Column:
        return F.aggregate(f"repeats_{side}", zero, lambda total, r: total + extra(r))

    of_a = more("a", lambda r: let(count("b", r["hash"]), lambda n: F.when(n > 0, r["n"] * n - 1).otherwise(zero)))
    of_b = more("b", lambda r: F.when(count("a", r["hash"]) == 1, r["n"] - 1).otherwise(zero))  # others are in of_a
    sides = [F.arrays_zip(F.col(f"hashes_{x}").alias("hash"), F.col(f"counts_{x}").alias("n")) for x in ("a", "b")]

    def products(both: Column) -> Column:  # a shared gram stands there twice, side by side
        def product(x: Column, i: Column) -> Column:
            before = F.get(both, i - 1)
            return F.when(before["hash"] == x["hash"], before["n"] * x["n"]).otherwise(zero)

        return F.aggregate(F.transform(both, product), zero, lambda total, x: total + x)

    few = F.size("repeats_a") + F.size("repeats_b") <= FEW_REPEATS
    return F.when(few, once + of_a + of_b).otherwise(let(F.array_sort(F.concat(*sides)), products))


SKETCH = 4  # words of 64 bits


def _sketch(hashes: Column) -> Column:
    """Struct of SKETCH numbers: a gram's hash names one of their bits, set if an odd number of grams name it."""

    def word(i: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda bits, h: F.when(F.pmod(h, F.lit(SKETCH)) == i, bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 8), F.lit(64)).cast("int")))).otherwise(bits))

    return F.struct(*[word(i).alias(f"s{i}") for i in range(SKETCH)])


def _apart(a: Column, b: Column) -> Column:
    """Bits that two sketches differ in: at most as many as there are grams that only one of the items has."""
    return sum((F.bit_count(a[f"s{i}"].bitwiseXOR(b[f"s{i}"])) for i in range(1, SKETCH)), F.bit_count(a["s0"].bitwiseXOR(b["s0"])))


def _numbered(items: DataFrame, grams: Column, staged: bool) -> DataFrame:
    """(number, item, hashes, counts, repeats): with a staged copy's rows numbered, so that items that are texts aren't shuffled."""
    pairs = F.arrays_zip(F.col("hashes").alias("hash"), F.col("counts").alias("n"))
    bags = packed_bags(items, grams).withColumn("repeats", F.filter(pairs, lambda p: p["n"] > 1))
    if not staged:
        return bags.withColumn("number", F.col("item"))
    return stage(bags.withColumn("number", F.monotonically_increasing_id()))


def _prefixes(bags: DataFrame, metric: str, min_score: float) -> DataFrame:
    """(item, gram, df, n, rest, left, whole, sketch) from `bags(number, hashes, counts)`: prefix rows of each item, by its
    number, rarest gram first.

    Mass is what a gram can add to a score: n squared for cosine, 1 for jaccard. `whole` is the
    item's mass, `rest` what it has from this gram on, `left` what it has after it. A gram of
    one item pairs nobody: it counts in `whole` and is dropped before the ranking.
    """
    zero = F.lit(0).cast("bigint")
    mass = F.col("n") * F.col("n") if metric == "cosine" else F.lit(1).cast("bigint")
    whole = F.aggregate("counts", zero, lambda total, n: total + n * n) if metric == "cosine" else F.size("hashes").cast("bigint")
    # `whole` is made below the rows of single grams, once an item
    rows = bags.withColumn("whole", whole).select(F.col("number").alias("item"), "whole", F.inline(F.arrays_zip(F.col("hashes").alias("gram"), F.col("counts").alias("n"))))
    # one shuffle by gram gives every row how many items have it; of most texts' grams hardly any are left then
    shared = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("df > 1")
    # from the most common gram down, so that the running sum is what follows in rarest-first order
    onward = Window.partitionBy("item").orderBy(F.desc("df"), F.desc("gram")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    needed = F.col("whole") * ((min_score * min_score if metric == "cosine" else min_score) - EPSILON)
    ranked = shared.withColumn("mass", mass).withColumn("rest", F.sum("mass").over(onward)).where(F.col("rest") >= needed)
    kept = ranked.select("item", "gram", "df", "n", "rest", (F.col("rest") - F.col("mass")).alias("left"), "whole")
    return kept.join(bags.select(F.col("number").alias("item"), _sketch(F.col("hashes")).alias("sketch")), "item")


def _size_class(size: Column, min_score: float) -> Column:
    """Sizes of a pair lie within a factor 1/min_score, so in the same or the next class."""
    return F.floor(F.log(size.cast("double")) / math.log(1 / min_score) + EPSILON)


def _candidates(prefixes: DataFrame, metric: str, min_score: float, salt_rows: int) -> DataFrame:
    """(a, b, whole_a, whole_b), a < b: pairs whose shared prefix grams leave the score in reach.

    Two items meet at a gram only if it could be the first they share: with nothing shared
    before, what both have from it on must still reach the score. That shortens the prefixes
    again, pair by pair, and first of all at the common grams, which come last. The grams that
    pass are the first ones a pair shares, so what it shares beyond them is bounded by what
    both have after the last of them. Most pairs out of reach are known by their sketches where they meet.

    A gram of many items is dealt over a salt for every `salt_rows` of them: one side by item,
    the other copied to each, so that no task holds the pairs of a hot gram alone. The other grams
    are shuffled once for both sides.
    """
    columns = [c for c in ("item", "n", "rest", "left", "whole", "sketch") if c in prefixes.columns]

    def sides(rows: DataFrame, salts: dict[str, Column]) -> list[DataFrame]:
        return [rows.select("gram", *([salts[x].alias("salt")] if salts else []), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in ("a", "b")]

    salts = F.ceil(F.col("df") / salt_rows)
    hot_a, hot_b = sides(
        prefixes.where(F.col("df") > salt_rows),
        {"a": F.pmod(F.xxhash64("item"), salts), "b": F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))},
    )
    keys = ["gram", "salt"]
    if metric == "jaccard" and min_score < 1:
        # the class splits the group of a gram that many items share
        here = _size_class(F.col("whole_b"), min_score)
        hot_a = hot_a.withColumn("class", _size_class(F.col("whole_a"), min_score))
        hot_b = hot_b.withColumn("class", F.explode(F.sequence(here - 1, here + 1)))
        keys.append("class")
    few_a, few_b = sides(prefixes.where(F.col("df") <= salt_rows), {})

    def bound(x: str) -> Column:
        a, b = F.col(f"{x}_a"), F.col(f"{x}_b")
        return F.least(a, b).cast("double") if metric == "jaccard" else F.sqrt(a.cast("double") * b)

    if metric == "jaccard":
        enough = (F.col("whole_a") + F.col("whole_b")) * ((min_score - EPSILON) / (1 + min_score))
    else:
        enough = F.sqrt(F.col("whole_a").cast("double") * F.col("whole_b")) * (min_score - EPSILON)
    meetings = [few_a.join(few_b, "gram").drop("gram"), hot_a.join(hot_b, keys).drop(*keys)]
    met = meetings[0].unionByName(meetings[1]).where((F.col("item_a") < F.col("item_b")) & (bound("rest") >= enough))
    if "sketch" in columns:
        # a gram of one item only adds one at least to the squared distance, whole_a + whole_b less twice the product
        most = (F.col("whole_a") + F.col("whole_b") - _apart(F.col("sketch_a"), F.col("sketch_b"))) / 2.0
        met = met.where(most >= enough - EPSILON)
    seen = F.sum(F.col("n_a") * F.col("n_b")) if metric == "cosine" else F.count(F.lit(1))
    pairs = met.groupBy("item_a", "item_b", "whole_a", "whole_b").agg(
        seen.alias("seen"), F.min("left_a").alias("left_a"), F.min("left_b").alias("left_b")
    )
    return pairs.where(F.col("seen") + bound("left") >= enough).select(
        F.col("item_a").alias("a"), F.col("item_b").alias("b"), "whole_a", "whole_b"
    )


def named(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, ...), a < b, with the items of `bags(number, item)` for the numbers of `pairs(a, b, ...)`."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    of_a, of_b = (bags.select(F.col("number").alias(x), F.col("item").alias(f"item_{x}")) for x in ("a", "b"))
    return pairs.join(of_a, "a").join(of_b, "b").select(F.least("item_a", "item_b").alias("a"), F.greatest("item_a", "item_b").alias("b"), *rest)


def similar_pairs(
    items: DataFrame, grams: Column, metric: str = "cosine", min_score: float = 0.9, staged: bool = True, salt_rows: int = 1000
) -> DataFrame:
    """(a, b, score) with score >= min_score, a < b, for all pairs of `items(item, ...)`.

    `metric` is `cosine` over gram counts or `jaccard` over gram sets; items without grams
    score 0. A pair is scored inside its row, from both items' bags. `staged` writes the bags, the prefixes
    and the candidates, so that the shuffles that made them can go; a bag is then sent once to each group of pairs that
    needs it, not with each pair, and of staged bags is known whether items share so many grams that comparing them tile
    by tile is cheaper than the index.
    """
    if metric not in ("cosine", "jaccard"):
        raise ValueError(f"unknown metric {metric!r}")
    if not 0 < min_score <= 1:
        raise ValueError("min_score must be above 0 and at most 1")
    bags = _numbered(items, grams, staged)
    if staged:
        tiled, n_items = share_most(bags)
        if tiled:
            return tiled_pairs(bags, metric, min_score, n_items)
    prefixes = _prefixes(bags, metric, min_score)
    pairs = _candidates(stage(prefixes) if staged else prefixes, metric, min_score, salt_rows)
    if staged:
        rows = bags.select(F.col("number").alias("item"), "hashes", *(["counts"] if metric == "cosine" else []))
        return named(judged(stage(pairs.select("a", "b")), rows, scores(metric)).where(F.col("score") >= min_score), bags)
    carried = ("item", "hashes") if metric == "jaccard" else ("item", "hashes", "counts", "repeats")
    of_a, of_b = (bags.select(F.col("number").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in carried]) for x in ("a", "b"))
    sums = pairs.join(of_a, "a").join(of_b, "b").withColumn("common", in_common(metric))
    if metric == "cosine":
        score = F.col("common") / (F.sqrt("whole_a") * F.sqrt("whole_b"))
    else:
        score = F.col("common") / (F.col("whole_a") + F.col("whole_b") - F.col("common"))
    ordered = [F.least("item_a", "item_b").alias("a"), F.greatest("item_a", "item_b").alias("b")]
    return sums.select(*ordered, score.alias("score")).where(F.col("score") >= min_score)


# --- min-hash ---------------------------------------------------------------------------------

MINHASH_PRIME = 2_147_483_647
CODE_POINTS = 1_114_112


def minhash_family(n_hashes: int, seed: int = 1) -> list[tuple[int, int]]:
    """(a, b) of h(x) = (a x + b) mod p from a fixed multiplicative rule, a > 0."""
    out, x = [], seed
    for _ in range(n_hashes):
        x = x * 48271 % MINHASH_PRIME
        a = x
        x = x * 48271 % MINHASH_PRIME
        out.append((a, x))
    return out


def gram_number(gram: str, n: int) -> str:
    """SQL: a gram of n characters as a number below the prime, from its code points."""
    out = "0"
    for i in range(1, n + 1):
        out = f"((({out}) * {CODE_POINTS}L + ascii(substring({gram}, {i}, 1))) % {MINHASH_PRIME}L)"
    return out


def minhash(items: DataFrame, grams: Column, n: int = 3, n_hashes: int = 8) -> DataFrame:
    """(item, h0, h1, ...): smallest hash of the item's grams per function, null without grams.

    Minima are combined on the map side, so one row per item and task is shuffled.
    """
    numbers = items.select("item", F.explode_outer(grams).alias("gram")).selectExpr(
        "item", f"CASE WHEN gram IS NOT NULL THEN {gram_number('gram', n)} END AS x"
    )
    hashes = [f"min(({a}L * x + {b}L) % {MINHASH_PRIME}L) AS h{i}" for i, (a, b) in enumerate(minhash_family(n_hashes))]
    return numbers.groupBy("item").agg(*[F.expr(h) for h in hashes])
