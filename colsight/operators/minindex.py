"""Similar texts by an index of min-hash bands, checked exactly.

Each item's grams are brought to `bands * rows` minima; the minima of a band together are a bucket.
Items that share a bucket are candidates, their shared minima estimate the similarity, and what the
estimate leaves in reach (three standard deviations) is compared gram by gram. So every pair that comes out
is right; a pair of similarity s is missed with probability (1 - s ** rows) ** bands, before the estimate.

A bucket of many items is dealt over a salt, one side by item, the other copied to each, as prefix grams
are; it isn't capped. Equal texts share all buckets: collapse them first with `similarity.representatives`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from colsight.operators.meeting import equal_share, judged, scores
from colsight.operators.similarity import named, packed_bags
from colsight.plans.staging import stage


def signatures(bags: DataFrame, n_hashes: int) -> DataFrame:
    """(item, minima): the smallest of each of `n_hashes` hashes over `hashes`, the item's grams; combined on the map side."""
    numbers = bags.select("item", F.explode("hashes").alias("x"))
    minima = numbers.groupBy("item").agg(*[F.min(F.xxhash64("x", F.lit(i))).alias(f"h{i}") for i in range(n_hashes)])
    return minima.select("item", F.array(*[f"h{i}" for i in range(n_hashes)]).alias("minima"))


def index(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, item): one row for each band of an item."""
    buckets = F.array(*[F.xxhash64(F.slice("minima", i * rows + 1, rows)) for i in range(bands)])
    return signed.select("item", F.posexplode(buckets).alias("band", "bucket"))


def candidates(entries: DataFrame, salt_rows: int = 1000) -> DataFrame:
    """(a, b), a < b: items that share a bucket, each pair once."""
    size = entries.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = entries.join(size, ["band", "bucket"]).withColumn("salts", F.ceil(F.col("n") / salt_rows))
    left = hot.select("band", "bucket", F.pmod(F.xxhash64("item"), F.col("salts")).alias("salt"), F.col("item").alias("a"))
    right = hot.select("band", "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.col("item").alias("b"))
    return left.join(right, ["band", "bucket", "salt"]).where("a < b").select("a", "b").distinct()


def estimated(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """(a, b, estimate): the share of minima that two items have in common."""
    return judged(pairs, signed, equal_share).withColumnRenamed("score", "estimate")


def near_pairs(items: DataFrame, grams: Column, min_score: float = 0.5, bands: int = 32, rows: int = 3, salt_rows: int = 1000) -> DataFrame:
    """(a, b, score, estimate): pairs of `items(item, ...)` whose gram sets reach the Jaccard score.

    Only rows of the index meet; items without grams meet nobody. The score is exact.
    """
    if not 0 < min_score <= 1:
        raise ValueError("min_score must be above 0 and at most 1")
    bags = stage(packed_bags(items, grams).select(F.monotonically_increasing_id().alias("number"), "item", "hashes"))
    numbered = bags.select(F.col("number").alias("item"), "hashes")
    signed = stage(signatures(numbered, bands * rows))
    slack = 3 * math.sqrt(min_score * (1 - min_score) / (bands * rows))
    pairs = stage(candidates(index(signed, bands, rows), salt_rows))
    likely = stage(estimated(pairs, signed).where(F.col("estimate") >= min_score - slack - 1e-9))
    right = judged(likely.select("a", "b"), numbered, scores("jaccard")).where(F.col("score") >= min_score)
    return named(right.join(likely, ["a", "b"]).select("a", "b", "score", "estimate"), bags)
