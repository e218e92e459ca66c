"""Hierarchy of similar items: a maximum spanning forest and cuts of it.

Single linkage at every level is held by the forest alone: two items are in one group at a level
exactly if the forest's edges of that score or more connect them. So the forest is found once, with
at most one edge an item, and cut as often as wanted.

The forest comes from rounds of best edges: every group takes the best edge that leaves it, groups
joined by these become one, edges inside a group go and of those between two groups only the best
stays. Groups at least halve each round. Best edges are minima combined on the map side, labels come
by equi-joins; no group is gathered. Equal scores are ordered by their items, so the forest is one
and the same however the edges lie. An edge that is the worst of a circle of some edges is the worst of a circle of
all, so every task first drops what isn't in the forest of its own edges.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from colsight.operators.components import PLAIN, by_chunks, components, numbered, rooted
from colsight.plans.staging import stage


def _best(edges: DataFrame, *keys: str) -> DataFrame:
    """The best edge of each key: highest score, then least items."""
    rest = [c for c in edges.columns if c not in (*keys, "loss", "a", "b")]
    return edges.groupBy(*keys).agg(F.min(F.struct("loss", "a", "b", *rest)).alias("e")).select(*keys, "e.*")


def _merged(best: DataFrame) -> DataFrame:
    """(root, up): the root each group ends at when all follow their best edges.

    Edges are in one total order, so the only circles are two groups that chose the same edge; of
    these the smaller stays. Then everyone asks the one it points to, which doubles the way.
    """
    up = best.select("root", F.col("other").alias("up"))
    back = up.select(F.col("root").alias("up"), F.col("up").alias("back"))
    at = stage(up.join(back, "up").select("root", F.when((F.col("back") == F.col("root")) & (F.col("root") < F.col("up")), F.col("root")).otherwise(F.col("up")).alias("up")))
    while True:
        ahead = at.select(F.col("root").alias("up"), F.col("up").alias("far"))
        further = stage(at.join(ahead, "up").select("root", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved")))
        at = further.select("root", "up")
        if further.where("moved").isEmpty():
            return at


def _best_edges(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Places of the forest's edges among edges of n numbered items, the best edge first."""
    at = np.arange(len(x))
    kept = np.zeros(len(x), bool)
    while True:
        apart = x != y
        x, y, at = x[apart], y[apart], at[apart]
        if not len(x):
            return np.flatnonzero(kept)
        none = len(kept)
        best = np.full(n, none)
        np.minimum.at(best, x, at)
        np.minimum.at(best, y, at)
        groups = np.flatnonzero(best < none)
        kept[best[groups]] = True
        chosen = np.searchsorted(at, best[groups])  # `at` ascends
        parent = np.arange(n)
        parent[groups] = np.where(x[chosen] == groups, y[chosen], x[chosen])
        back = parent[parent] == np.arange(n)  # two that chose the same edge: the smaller stays
        stays = back & (np.arange(n) < parent)
        parent[stays] = np.flatnonzero(stays)
        parent = rooted(parent)
        x, y = parent[x], parent[y]


def _forest(table: pa.Table) -> pa.Table:
    a, b, items = numbered(*(table.column(c).combine_chunks() for c in ("a", "b")))
    loss = pc.fill_null(table.column("loss"), float("-inf")).to_numpy()  # null comes first, as in `_best`
    order = np.lexsort((b, a, loss))
    return table.take(pa.array(order[_best_edges(a[order], b[order], len(items))]))


def thinned(edges: DataFrame) -> DataFrame:
    """Those of `edges(a, b, loss)`, a < b, that are in the forest of their task's edges."""
    kinds = {c: edges.schema[c].dataType for c in ("a", "b", "loss")}
    if not (isinstance(kinds["a"], PLAIN) and isinstance(kinds["b"], PLAIN) and isinstance(kinds["loss"], T.DoubleType)):
        return edges
    return edges.mapInArrow(by_chunks(_forest), edges.schema)


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(a, b, score), a < b: the maximum spanning forest of `edges(a, b, score)`."""
    ends = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (-F.col("score")).alias("loss"))
    current = stage(thinned(ends).groupBy("a", "b").agg(F.min("loss").alias("loss")).select(F.col("a").alias("x"), F.col("b").alias("y"), "loss", "a", "b"))
    found = current.select("a", "b", "loss").limit(0)
    while True:
        both = current.withColumnsRenamed({"x": "root", "y": "other"}).unionByName(current.withColumnsRenamed({"y": "root", "x": "other"}))
        best = stage(_best(both, "root"))
        if best.isEmpty():
            return found.select("a", "b", (-F.col("loss")).alias("score"))
        found = found.unionByName(best.select("a", "b", "loss").distinct())
        up = _merged(best)
        x, y = (up.select(F.col("root").alias(c), F.col("up").alias(f"{c}_up")) for c in ("x", "y"))
        moved = current.join(x, "x").join(y, "y").where("x_up <> y_up")
        moved = moved.select(F.least("x_up", "y_up").alias("x"), F.greatest("x_up", "y_up").alias("y"), "loss", "a", "b")
        current = stage(_best(moved, "x", "y"))


def cuts(forest: DataFrame, items: DataFrame, levels: Iterable[float]) -> DataFrame:
    """(item, level, cluster_id): the groups of `items(item)` at each level, from one forest.

    All levels are one run: an item stands once for each level.
    """
    spark = forest.sparkSession
    chosen = spark.createDataFrame([(float(x),) for x in levels], "level double")
    at = forest.join(chosen, F.col("score") >= F.col("level"))  # a handful of levels
    edges = at.select(*[F.struct("level", F.col(c).alias("item")).alias(c) for c in ("a", "b")])
    nodes = items.select("item").distinct().withColumn("level", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    grouped = components(edges, nodes.select(F.struct("level", "item").alias("item")))
    return grouped.select("item.item", "item.level", F.col("cluster_id.item").alias("cluster_id"))


def inconsistency(forest: DataFrame) -> DataFrame:
    """(a, b, score, neighbours, coefficient): how far an edge's height (1 - score) lies above those of the
    forest's edges that meet it, in their standard deviations (of a sample; null with fewer than two, or none).

    Read off sums per item: those of both ends without the edge itself. Heights are whole millionths,
    so that sums are exact and equal heights have no spread.
    """
    height = F.round((F.lit(1.0) - F.col("score")) * 1_000_000).cast("decimal(19,0)")
    ends = forest.select(F.explode(F.array("a", "b")).alias("item"), height.alias("h"))
    sums = ends.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum("h").cast("decimal(19,0)").alias("s"), F.sum(F.col("h") * F.col("h")).cast("decimal(38,0)").alias("q"))
    sides = {x: sums.select(F.col("item").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "s", "q")]) for x in ("a", "b")}
    both = forest.join(sides["a"], "a").join(sides["b"], "b").withColumn("h", height)
    met = both.select(
        "a", "b", "score", "h", (F.col("n_a") + F.col("n_b") - 2).alias("n"), (F.col("s_a") + F.col("s_b") - 2 * F.col("h")).cast("decimal(19,0)").alias("s"),
        (F.col("q_a") + F.col("q_b") - 2 * F.col("h") * F.col("h")).cast("decimal(28,0)").alias("q"),
    )
    n = F.col("n").cast("double")
    spread = F.sqrt((F.col("n").cast("decimal(10,0)") * F.col("q") - F.col("s") * F.col("s")).cast("double") / (n * (n - 1)))
    coefficient = F.when((F.col("n") > 1) & (spread > 0), (F.col("h").cast("double") - F.col("s").cast("double") / n) / spread)
    return met.select("a", "b", "score", F.col("n").alias("neighbours"), coefficient.alias("coefficient"))


def consistent_groups(forest: DataFrame, items: DataFrame, most: float = 0.9) -> DataFrame:
    """(item, cluster_id): groups left when edges with a coefficient above `most` are cut."""
    kept = inconsistency(forest).where(F.col("coefficient").isNull() | (F.col("coefficient") <= most))
    return components(kept.select("a", "b"), items)
