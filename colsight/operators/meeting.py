"""Pairs judged from large rows of both items, without sending a row once for each of its pairs.

Pairs of near copies come in thick groups. A pair is judged where the first item stands that is paired with its
second one: a group's pairs meet in one place, or a few, and a row is sent once to each such place. There the rows
come first and the pairs run past them. Places of very many rows are cut into cells of two slices of them, so a task
holds a bounded number of rows, whatever a group's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from colsight.plans.staging import stage

SLICE = 2048  # rows of a place that are held together, twice
MARKS = 1 << 22  # bits of the map of items that are in pairs, 64 to a row

Judge = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _marked(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of `rows(item, ...)` but those that surely aren't among `items(item)`; some of them may stay."""
    at = F.pmod(F.xxhash64("item"), F.lit(MARKS))
    marks = items.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
    # of a fixed size: MARKS / 64 rows of two numbers
    met = rows.join(F.broadcast(stage(marks)), F.shiftright(at, 6) == F.col("word")).where(F.getbit("bits", (at % 64).cast("int")) == 1)
    return met.select(*rows.columns)


def _cells(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(place, cell, a, b) of `pairs(a, b)`, staged, and (place, cell, item) of the items each cell needs."""
    placed = stage(pairs.select("a", "b").withColumn("place", F.min("a").over(Window.partitionBy("b"))))
    needed = stage(placed.select("place", F.explode(F.array("a", "b")).alias("item")).distinct())
    wide = stage(needed.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SLICE).select("place", F.ceil(F.col("n") / SLICE).alias("slices")))
    zero = F.lit(0).cast("bigint")
    if wide.isEmpty():
        return placed.withColumn("cell", zero), needed.withColumn("cell", zero)

    def slice_of(item: str) -> Column:
        return F.pmod(F.xxhash64(item), F.col("slices"))

    def cell(one: Column, two: Column) -> Column:
        return F.least(one, two) * F.col("slices") + F.greatest(one, two)

    cut = F.col("slices").isNotNull()
    others = F.when(cut, F.sequence(zero, F.col("slices") - 1)).otherwise(F.array(zero))
    met = needed.join(wide, "place", "left").withColumn("other", F.explode(others))
    return (
        placed.join(wide, "place", "left").select("place", F.when(cut, cell(slice_of("a"), slice_of("b"))).otherwise(zero).alias("cell"), "a", "b"),
        met.select("place", F.when(cut, cell(slice_of("item"), F.col("other"))).otherwise(zero).alias("cell"), "item"),
    )


def _task(make: Callable[[dict[str, pa.Array]], Judge], fields: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, items, judge = None, [], None, None
        for batch in batches:
            key = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "cell", "is_pair")]
            cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in key])) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if low == high:
                    continue
                here, part = (key[0][low], key[1][low]), batch.slice(low, high - low)
                if here != last:
                    last, rows, judge = here, [], None
                if not key[2][low]:
                    rows.append(part)
                    continue
                if judge is None:
                    table = pa.Table.from_batches(rows).combine_chunks()
                    items, rows = table.column("x").to_numpy(), []  # sorted
                    judge = make({c: pa.chunked_array(table.column(c)).combine_chunks() for c in fields})
                a, b = part.column("x"), part.column("y")
                found = judge(np.searchsorted(items, a.to_numpy()), np.searchsorted(items, b.to_numpy()))
                yield pa.RecordBatch.from_arrays([a, b, pa.array(found)], ["a", "b", "score"])

    return task


def judged(pairs: DataFrame, rows: DataFrame, make: Callable[[dict[str, pa.Array]], Judge]) -> DataFrame:
    """(a, b, score) of `pairs(a, b)`, a < b, whole numbers, each pair once, from `rows(item, ...)`, one row an item.

    `make` gets a cell's rows, a column each, and gives the function that scores pairs of them, two arrays of their
    places.
    """
    placed, needed = _cells(pairs)
    fields = [c for c in rows.columns if c != "item"]
    sent = needed.join(_marked(rows, needed), "item")
    as_rows = sent.select("place", "cell", F.lit(False).alias("is_pair"), F.col("item").cast("bigint").alias("x"), F.lit(None).cast("bigint").alias("y"), *fields)
    as_pairs = placed.select(
        "place", "cell", F.lit(True).alias("is_pair"), F.col("a").cast("bigint").alias("x"), F.col("b").cast("bigint").alias("y"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in fields],
    )
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = as_rows.unionByName(as_pairs).withColumn("place", F.col("place").cast("bigint")).repartition(parts, "place", "cell").sortWithinPartitions("place", "cell", "is_pair", "x")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("score", T.DoubleType())])
    return met.mapInArrow(_task(make, fields), schema)


def scores(metric: str) -> Callable[[dict[str, pa.Array]], Judge]:
    """Cosine over `hashes` and `counts`, or Jaccard over `hashes` alone."""

    def make(columns: dict[str, pa.Array]) -> Judge:
        sizes = pc.list_value_length(columns["hashes"]).to_numpy().astype(np.int64)
        starts = np.append(0, np.cumsum(sizes))
        grams, codes = np.unique(columns["hashes"].flatten().to_numpy(), return_inverse=True)
        counts = columns["counts"].flatten().to_numpy().astype(np.int64) if metric == "cosine" else np.ones(len(codes), np.int64)
        whole = np.add.reduceat(counts * counts, starts[:-1])
        held = np.zeros(len(grams), np.int64)

        def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.zeros(len(a), np.int64)
            cuts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))  # pairs come sorted by their first item
            for low, high in zip(cuts, np.append(cuts[1:], len(a))):
                own = slice(starts[a[low]], starts[a[low] + 1])
                held[codes[own]] = counts[own]
                for at in range(low, high, 256):
                    others = b[at : min(at + 256, high)]
                    n = sizes[others]
                    ends = np.cumsum(n)
                    places = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - n), n)
                    out[at : at + len(others)] = np.add.reduceat(held[codes[places]] * counts[places], ends - n)
                held[codes[own]] = 0
            return out

        def judge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            shared, whole_a, whole_b = common(a, b), whole[a], whole[b]
            return shared / (np.sqrt(whole_a) * np.sqrt(whole_b)) if metric == "cosine" else shared / (whole_a + whole_b - shared)

        return judge

    return make


def equal_share(columns: dict[str, pa.Array]) -> Judge:
    """The share of places at which two rows of `minima` are equal."""
    minima = columns["minima"]
    table = minima.flatten().to_numpy().reshape(len(minima), -1)

    def judge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a))
        for at in range(0, len(a), 4096):
            part = slice(at, at + 4096)
            out[part] = np.count_nonzero(table[a[part]] == table[b[part]], axis=1) / table.shape[1]
        return out

    return judge
