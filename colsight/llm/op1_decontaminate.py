"""Search of short test items inside long documents.

Size-partitioned min-hash signatures find candidates, exact shingle containment decides. Items are in classes
by size, [2^j, 2^(j+1)) distinct shingles. A class fixes the length L of its signatures, the minima of a
weighted min-hash: shingles that few documents have come first, hashes order the equally rare. A document that
holds a share `threshold` of an item's n shingles misses at most f = floor((1 - threshold) n) of them and so has
L - f of any L; L is f + 1 for the largest size of the class, so that at least one must be met, and a candidate
has to meet L - f. None is missed, and a phrase that many documents share makes candidates only of items that
consist of little else.

Words are ASCII-lower-cased runs of anything but ASCII white space, shingles are five words; an item of fewer
words is one shingle of them all, which is looked for among the runs of so many words. Null or empty items are
in no document, null or empty texts contain nothing. Repeated items are found each; repeated document rows give
repeated result rows only once (doc_id, item_id).
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from colsight.llm.common import WordHashes, batch_of, bitmap, grams, has_bit, lower_words, map_arrow, mix, names_apart, set_apart, signed, stage, text_hash, texts

SHINGLE, CONTAINMENT, FILTER_BITS = 5, 0.8, 1 << 25


def _must_have(n: int, threshold: float) -> int:
    return max(1, ceil(n * threshold - 1e-6))


def runs_of(hashes: np.ndarray, m: int) -> np.ndarray:
    """Hash of every `m` consecutive words; runs of different lengths have different hashes."""
    return mix(grams(hashes, m) + np.uint64(m))


def item_shingles(items: DataFrame, k: int = SHINGLE, threshold: float = CONTAINMENT) -> DataFrame:
    """(item_row, item_id, m, n, least, length, s): a row for each of an item's `n` distinct shingles of `m`
    words, with the number that a document must have and the length of its class's signatures."""

    def make():
        memo = WordHashes()

        def run(batch):
            if batch is None:
                return []
            told, found = [], []
            for row, item, text in zip(batch.column("item_row").to_pylist(), batch.column("item_id").to_pylist(), texts(batch)):
                words = lower_words(text)
                if not words:
                    continue
                m = min(k, len(words))
                s = np.unique(runs_of(memo.of(words), m))
                n, top = len(s), (1 << len(s).bit_length()) - 1
                told += [(row, item, m, n, _must_have(n, threshold), min(n, top - _must_have(top, threshold) + 1))] * n
                found.append(s)
            if not told:
                return []
            columns = dict(zip(("item_row", "item_id", "m", "n", "least", "length"), (pa.array(c, pa.int64()) for c in zip(*told))))
            return [batch_of(**columns, s=signed(np.concatenate(found)))]

        return run

    rows = items.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return map_arrow(rows, make, "item_row bigint, item_id bigint, m bigint, n bigint, least bigint, length bigint, s bigint")


def document_hits(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(row_id, doc_id, text_hash, s): the distinct shingles of every document row that an item has too, told by
    two bits each in a bitmap of fixed size, so that very few others are among them."""
    places = F.explode(F.array("s", F.shiftright("s", 32)))
    lengths = sorted(r["m"] for r in shingles.select("m").distinct().collect())  # at most SHINGLE
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(shingles.select(places.alias("at")), F.col("at"), FILTER_BITS))
    low = np.uint64(FILTER_BITS - 1)

    def make():
        memo, bits = WordHashes(), shared.value

        def known(s: np.ndarray) -> np.ndarray:
            s = s[has_bit(bits, (s & low).astype(np.int64))]
            return s[has_bit(bits, (s >> np.uint64(32) & low).astype(np.int64))]

        def run(batch):
            if batch is None:
                return []
            at, found = [], []
            for i, text in enumerate(texts(batch)):
                hashes = memo.of(lower_words(text))
                s = np.unique(np.concatenate([known(runs_of(hashes, m)) for m in lengths] or [np.empty(0, np.uint64)]))
                if len(s):
                    at.append(np.full(len(s), i))
                    found.append(s)
            if not at:
                return []
            rows = batch.select(["row_id", "doc_id", "text_hash"]).take(pa.array(np.concatenate(at)))
            return [batch_of(**dict(zip(rows.schema.names, rows.columns)), s=signed(np.concatenate(found)))]

        return run

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("bigint"), text_hash().alias("text_hash"), F.col("text").cast("string"))
    return map_arrow(rows, make, "row_id bigint, doc_id bigint, text_hash bigint, s bigint")


def signatures(shingles: DataFrame, hits: DataFrame) -> DataFrame:
    """Of every item the `length` shingles that come first: by the number of documents, then by hash."""
    seen = hits.groupBy("s").agg(F.count(F.lit(1)).alias("seen"))
    order = Window.partitionBy("item_row").orderBy(F.coalesce("seen", F.lit(0)), "s")
    return shingles.join(seen, "s", "left").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("length"))


def candidates(hits: DataFrame, chosen: DataFrame) -> DataFrame:
    """(row_id, item_row) of documents that meet as much of an item's signature as they must."""
    met = hits.select("row_id", "s").join(chosen.select("s", "item_row", (F.col("length") - F.col("n") + F.col("least")).alias("need")), "s")
    return met.groupBy("row_id", "item_row", "need").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= F.col("need")).select("row_id", "item_row")


def search(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every item that a document contains; rows without doc_id
    and items without item_id can't be named and give no rows here, though `decontaminate` obeys them."""
    found = _contained(docs, items, k, threshold).where(F.col("item_id").isNotNull() & F.col("doc_id").isNotNull())
    found = found.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def _contained(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = CONTAINMENT) -> DataFrame:
    """`search` with a row for each pair of rows, also of those without an id, and the hash of the document's
    text: rows of one doc_id can differ in it."""
    shingles = stage(item_shingles(items, k, threshold))
    hits = stage(document_hits(docs, shingles))
    pairs = candidates(hits, signatures(shingles, hits))
    wanted = pairs.join(shingles.select("item_row", "item_id", "n", "least", "s"), "item_row")
    same = wanted.join(hits, ["row_id", "s"]).groupBy("row_id", "item_row", "doc_id", "text_hash", "item_id", F.col("n").alias("n_item"), "least")
    return same.agg(F.count(F.lit(1)).alias("n_shared")).where(F.col("n_shared") >= F.col("least"))


@names_apart
def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows that contain an item, also those without doc_id; another text under the doc_id of
    one that goes stays."""
    bad = stage(_contained(docs, items, **options).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text")).distinct())
    clean, rest = set_apart(docs, bad)
    rest = rest.join(bad, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (text_hash() == F.col("__text")), "left_anti")
    return clean.unionByName(rest)
