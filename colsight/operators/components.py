"""Groups of connected items from an edge table.

Alternating large-star and small-star steps: every step points items at the smallest
neighbour known, so the rounds grow with the logarithm of the group size. Minima are
partial aggregates; the join back to the edges is an equi-join on the item, which AQE
splits where one item has very many neighbours. No group is ever gathered in one task.

Before that, every task brings its own edges to one for an item they connect (`thinned`), which connect the same
items: of very many edges, as pairs of similar names are, hardly any are written and shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from colsight.plans.staging import drop, stage

CHUNK = 500_000  # edges that a task takes at a time
MOST_HELD = 1_000_000  # edges that it keeps beside them
PLAIN = (T.IntegralType, T.StringType, T.DateType)  # items that tasks can order as Spark does


def rooted(parent: np.ndarray) -> np.ndarray:
    """Where everyone ends who follows `parent`."""
    while not np.array_equal(parent, up := parent[parent]):
        parent = up
    return parent


def labels(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least number of the group of each of n items, from edges of their numbers."""
    parent = np.arange(n)
    while len(x):
        x, y = parent[x], parent[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        parent = rooted(parent)
    return parent


def numbered(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Both ends by number, and the items of these numbers, in ascending order."""
    both = pa.concat_arrays([x, y]).dictionary_encode()
    order = pc.array_sort_indices(both.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    at = rank[both.indices.to_numpy()]
    return at[: len(x)], at[len(x) :], both.dictionary.take(order)


def by_chunks(less: Callable[[pa.Table], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives its edges to `less` a chunk at a time, with those that `less` has left of the chunks before."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        kept, n = 0, 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                left = less(pa.Table.from_batches(held).combine_chunks())
                held, kept, n = left.to_batches(), left.num_rows, 0
                if kept > MOST_HELD:
                    yield from held
                    held = []
        if held:
            yield from less(pa.Table.from_batches(held).combine_chunks()).to_batches()

    return task


def _stars(table: pa.Table) -> pa.Table:
    x, y, items = numbered(*(table.column(c).combine_chunks() for c in ("u", "v")))
    at = labels(x, y, len(items))
    moved = np.flatnonzero(at != np.arange(len(items)))
    return pa.table([items.take(pa.array(moved)), items.take(pa.array(at[moved]))], ["u", "v"])


def thinned(edges: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the same items as those of `edges(u, v)`; of a task's, at most one for each of its items."""
    if not all(isinstance(f.dataType, PLAIN) for f in edges.schema):
        return edges
    return edges.mapInArrow(by_chunks(_stars), edges.schema)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame, items: DataFrame | None = None, max_rounds: int = 50) -> DataFrame:
    """(item, cluster_id): cluster_id is the smallest item of the group.

    `edges(a, b)`; items of `items(item)` without an edge form groups of their own.
    Each round is written to the shared folder, which cuts the plan and survives lost executors; the
    round before goes then.
    Rounds grow with the logarithm of the largest group; a graph that needs more than
    `max_rounds` ends in an error, nothing is dropped.
    """
    current = stage(thinned(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where(F.col("a") != F.col("b"))))  # the first step takes out repeats
    before = None
    for _ in range(max_rounds):
        after = _fingerprint(current)
        if after == before:
            break
        before = after
        last, current = current, stage(_small_star(_large_star(current)))
        drop(last)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    members = current.select(F.col("u").alias("item"), F.col("v").alias("cluster_id"))
    roots = members.select(F.col("cluster_id").alias("item"), "cluster_id").distinct()
    grouped = members.unionByName(roots)
    if items is None:
        return grouped
    return items.select("item").distinct().join(grouped, "item", "left").select(
        "item", F.coalesce("cluster_id", "item").alias("cluster_id")
    )


def cluster_lists(clusters: DataFrame, cluster_map: DataFrame, contains: str | None = None) -> DataFrame:
    """(semantic_type, item): the items of chosen clusters, `cluster_map(cluster_id, semantic_type)`."""
    out = clusters.join(cluster_map, "cluster_id").select("semantic_type", "item")
    return out if contains is None else out.where(F.col("item").contains(contains))
