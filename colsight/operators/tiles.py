"""Similar pairs among items that share most of their grams, as names of one site do.

There an index leads nowhere: nearly all items meet at nearly every gram. Items are sorted and cut into tiles of
bounded size, and each two tiles meet in one group, so every pair is looked at once, whatever it shares, and comes
out with its score; pairs are neither shuffled nor kept. Inside, tiles are compared block by block: a block's largest
counts bound what an item can share with it, only items that can reach the score go on, and their grams in
common are counted by one product of matrices. Counts are whole numbers, so the scores are exact.

The work grows with the square of the items, as their pairs do; memory with a tile, what is shuffled with items times tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

FEW_GRAMS = 200  # distinct grams for each gram of a mean item, up to which tiles beat the index
LEAST_TILE, MOST_TILE, TILES = 2048, 16384, 16  # items in a tile; tiles wanted of few items
BLOCK = 2048  # items of a tile compared at a time
WIDTH = 4096  # grams of a block held at a time
ROWS = 50_000  # pairs in a batch
EPSILON = 1e-9


def share_most(bags: DataFrame) -> tuple[bool, int]:
    """Whether items of `bags(item, hashes)` share so many grams that tiles are cheaper than the index, and the number
    of items. Both ways give the same pairs, so distinct grams are estimated by a sketch."""
    items, grams = bags.agg(F.count(F.lit(1)), F.sum(F.size("hashes").cast("bigint"))).first()
    if not items:
        return False, 0
    distinct = bags.select(F.explode("hashes").alias("gram")).agg(F.approx_count_distinct("gram")).first()[0]
    return distinct * items <= FEW_GRAMS * grams, items


class _Bags:
    """Items' grams, numbered from 0, one item after the other."""

    def __init__(self, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray):
        self.sizes, self.codes, self.counts = sizes, codes, counts
        self.starts = np.append(0, np.cumsum(sizes))
        self.whole = np.add.reduceat(counts * counts, self.starts[:-1])

    def __len__(self) -> int:
        return len(self.sizes)

    def cut(self, low: int, high: int) -> _Bags:
        at = slice(self.starts[low], self.starts[high])
        return _Bags(self.sizes[low:high], self.codes[at], self.counts[at])

    def only(self, rows: np.ndarray) -> _Bags:
        """The items where `rows` is true."""
        if rows.all():
            return self
        kept = np.repeat(rows, self.sizes)
        return _Bags(self.sizes[rows], self.codes[kept], self.counts[kept])

    def most(self, width: int) -> np.ndarray:
        """The largest count of each gram."""
        out = np.zeros(width)
        np.maximum.at(out, self.codes, self.counts)
        return out

    def reach(self, most: np.ndarray) -> np.ndarray:
        """The most that each item can share with items of these largest counts."""
        return np.add.reduceat(self.counts * most[self.codes], self.starts[:-1])

    def matrix(self, columns: np.ndarray, width: int, kind: type) -> np.ndarray:
        place = np.full(width, -1)
        place[columns] = np.arange(len(columns))
        at = place[self.codes]
        held = at >= 0
        out = np.zeros((len(self), len(columns)), kind)
        out[np.repeat(np.arange(len(self)), self.sizes)[held], at[held]] = self.counts[held]
        return out


def _enough(a, b, metric: str, min_score: float):
    """What items of mass a and b must share."""
    if metric == "jaccard":
        return (a + b) * ((min_score - EPSILON) / (1 + min_score))
    return np.sqrt(a) * np.sqrt(b) * (min_score - EPSILON)


def _common(a: _Bags, b: _Bags, columns: np.ndarray, width: int) -> np.ndarray:
    kind = np.float32 if max(a.whole.max(), b.whole.max()) < 1 << 24 else np.float64  # no product is larger
    out = np.zeros((len(a), len(b)), kind)
    for at in range(0, len(columns), WIDTH):
        part = columns[at : at + WIDTH]
        out += a.matrix(part, width, kind) @ b.matrix(part, width, kind).T
    return out


def _block_pairs(a: _Bags, b: _Bags, most_b: np.ndarray, metric: str, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(row of a, row of b, score) of the pairs of two blocks."""
    width = len(most_b)
    near_a = a.reach(most_b) >= _enough(a.whole, b.whole.min(), metric, min_score)
    if not near_a.any():
        return None
    few_a = a.only(near_a)
    most_a = few_a.most(width)
    near_b = b.reach(most_a) >= _enough(b.whole, few_a.whole.min(), metric, min_score)
    if not near_b.any():
        return None
    few_b = b.only(near_b)
    common = _common(few_a, few_b, np.flatnonzero((most_a > 0) & (most_b > 0)), width)
    x, y = np.nonzero(common >= _enough(few_a.whole[:, None], few_b.whole[None, :], metric, min_score).astype(common.dtype) * common.dtype.type(1 - 1e-5))
    shared, whole_a, whole_b = common[x, y].astype(np.float64), few_a.whole[x], few_b.whole[y]
    score = shared / (whole_a + whole_b - shared) if metric == "jaccard" else shared / (np.sqrt(whole_a) * np.sqrt(whole_b))
    kept = score >= min_score
    return np.flatnonzero(near_a)[x[kept]], np.flatnonzero(near_b)[y[kept]], score[kept]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from a stream sorted by `key`."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        key = batch.column("key").to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if held and key[low] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key[low]
    if held:
        yield pa.Table.from_batches(held)


def _tile_pairs(table: pa.Table, tiles: int, metric: str, min_score: float) -> Iterator[pa.RecordBatch]:
    """(a, b, score) of one group: the rows of two tiles, or of one that meets itself."""
    first, second = divmod(table.column("key")[0].as_py(), tiles)
    split = int(np.count_nonzero(table.column("tile").to_numpy() == first))
    if first != second and split in (0, table.num_rows):
        return
    hashes = pa.chunked_array(table.column("hashes")).combine_chunks()
    grams, codes = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
    counts = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.float64) if metric == "cosine" else np.ones(len(codes))
    whole = _Bags(pc.list_value_length(hashes).to_numpy().astype(np.int64), codes, counts)
    items = table.column("item").combine_chunks()
    rows = [range(0, split), range(0, split) if first == second else range(split, table.num_rows)]
    blocks = [[(at, whole.cut(at, min(at + BLOCK, side.stop))) for at in range(side.start, side.stop, BLOCK)] for side in rows]
    most = [b.most(len(grams)) for _, b in blocks[1]]
    for at_a, a in blocks[0]:
        for (at_b, b), most_b in zip(blocks[1], most):
            if at_b < at_a:  # in a tile that meets itself
                continue
            found = _block_pairs(a, b, most_b, metric, min_score)
            if found is None:
                continue
            x, y, score = found[0] + at_a, found[1] + at_b, found[2]
            if at_a == at_b:
                x, y, score = (c[found[0] < found[1]] for c in (x, y, score))
            for at in range(0, len(x), ROWS):
                part = slice(at, at + ROWS)
                yield pa.RecordBatch.from_arrays([items.take(pa.array(x[part])), items.take(pa.array(y[part])), pa.array(score[part])], ["a", "b", "score"])


def tiled_pairs(bags: DataFrame, metric: str, min_score: float, n_items: int) -> DataFrame:
    """(a, b, score) with score >= min_score, a < b, for all pairs of `bags(item, hashes, counts)`, one row an item."""
    tiles = max(1, -(-n_items // min(MOST_TILE, max(LEAST_TILE, -(-n_items // TILES)))))
    counts = ["counts"] if metric == "cosine" else []
    tile, other = F.spark_partition_id(), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    # numbers in the order of the items, so that near ones lie in one block and the first of a pair is the lesser
    ordered = bags.select("item", "hashes", *counts).repartitionByRange(tiles, "item").sortWithinPartitions("item")
    placed = ordered.withColumn("number", F.monotonically_increasing_id()).withColumn("tile", tile).withColumn("other", other)
    key = (F.least("tile", "other").cast("bigint") * tiles + F.greatest("tile", "other")).alias("key")
    met = placed.select(key, "number", "tile", "item", "hashes", *counts).repartition(tiles * (tiles + 1) // 2, "key").sortWithinPartitions("key", "number")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            yield from _tile_pairs(table, tiles, metric, min_score)

    item = bags.schema["item"].dataType
    return met.mapInArrow(task, T.StructType([T.StructField("a", item), T.StructField("b", item), T.StructField("score", T.DoubleType())]))
