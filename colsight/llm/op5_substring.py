"""Removal of passages that occur in an earlier document.

A window is `window` consecutive words. Each window is represented by its smallest
`window / 2`-word gram (its seed); equal windows have equal seeds, so the number of documents
with a seed bounds the number with a window from above. Every task counts its seeds in a
count-min sketch; the merged sketch overestimates, so a window whose seed is estimated once
occurs once. A second pass sends only the others, one row a window and task (a task keeps the
smallest document and settles the rest itself, which is what a hot passage shrinks to), and the
sorted windows give every later document the places to remove. No window is lost.

Words are runs of anything but ASCII white space, unchanged. Null or empty texts and texts
shorter than a window lose nothing; rows without doc_id neither lose nor remove anything.
Documents are ordered by doc_id; repeated rows of one doc_id don't remove each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import WordHashes, batch_of, has_bit, map_arrow, mix, names_apart, stage, texts
from colsight.llm.spans import WINDOW_SCHEMA, Windows, later_windows, seeds_of
from colsight.llm.spans import digest as digest_without, removed

WINDOW = 50
CELLS = 1 << 26  # of each of the sketch's two rows; more only save shuffled windows
SHARD = 1 << 20
SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))  # fixed values
HELD = 2_000_000  # seeds a task holds at once


def _cells(seeds: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(seeds ^ SALTS[row]) & np.uint64(cells - 1)).astype(np.int64)


def sketch(docs: DataFrame, window: int = WINDOW, cells: int = CELLS) -> DataFrame:
    """(shard, bits): for each part of each row of the merged sketch, the cells counted twice or more."""
    shard_size = min(SHARD, cells)
    shards = cells // shard_size

    def make():
        memo, held = WordHashes(), []

        def flush():
            if not held:
                return []
            seeds = np.concatenate(held)
            held.clear()
            out = []
            for row in range(2):
                at, n = np.unique(_cells(seeds, row, cells), return_counts=True)
                coded = (at % shard_size).astype(np.uint32) * np.uint32(2) + (n > 1)
                ends = np.searchsorted(at, np.arange(1, shards + 1) * shard_size)
                for s, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                    if b > a:
                        out.append((row * shards + s, coded[a:b].astype("<u4").tobytes()))
            shard, data = zip(*out)
            return [batch_of(shard=pa.array(shard, pa.int32()), data=pa.array(data, pa.binary()))]

        def run(batch):
            if batch is None:
                return flush()
            for text in texts(batch):
                words = text.split() if text else []
                if len(words) >= window:
                    held.append(np.unique(seeds_of(memo.of(words), window)))
            return flush() if sum(map(len, held)) > HELD else []

        return run

    def merge():
        counts: dict[int, np.ndarray] = {}

        def run(batch):
            if batch is None:
                bits = [np.packbits(c > 1, bitorder="little").tobytes() for c in counts.values()]
                return [batch_of(shard=pa.array(list(counts), pa.int32()), bits=pa.array(bits, pa.binary()))] if counts else []
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                coded = np.frombuffer(data, "<u4")
                mine = counts.setdefault(shard, np.zeros(shard_size, np.uint8))
                at = coded >> 1
                mine[at] = np.minimum(mine[at] + 1 + (coded & 1).astype(np.uint8), 2)
            return []

        return run

    parts = map_arrow(docs.where(F.col("doc_id").isNotNull()).select(F.col("text").cast("string")), make, "shard int, data binary")
    return map_arrow(parts.repartition(min(2 * shards, 64), "shard"), merge, "shard int, bits binary", rows=16)


def sketch_bits(docs: DataFrame, window: int = WINDOW, cells: int = CELLS) -> list[np.ndarray]:
    """The merged sketch: two bitmaps of `cells` bits, whatever the input."""
    size = min(SHARD, cells) // 8
    bits = [np.zeros(cells // 8, np.uint8) for _ in range(2)]
    for row in sketch(docs, window, cells).toLocalIterator():
        r, s = divmod(row["shard"], cells // min(SHARD, cells))
        bits[r][s * size : (s + 1) * size] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def repeats(docs: DataFrame, window: int = WINDOW, cells: int = CELLS) -> DataFrame:
    """(doc_id, row_key, starts): the windows of a document that also start in one with a smaller
    doc_id. Documents without any are left out."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(sketch_bits(docs, window, cells))

    def make():
        memo, bits, found = WordHashes(), shared.value, Windows(window, within=False)

        def run(batch):
            if batch is None:
                return found.flush()
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = text.split() if text else []
                if len(words) < window:
                    continue
                hashes = memo.of(words)
                seeds = seeds_of(hashes, window)
                again = has_bit(bits[0], _cells(seeds, 0, cells))
                again &= has_bit(bits[1], _cells(seeds, 1, cells))
                if again.any():
                    out += found.add(doc, text, hashes, np.flatnonzero(again), seeds)
            return out

        return run

    windows = map_arrow(docs.where(F.col("doc_id").isNotNull()), make, WINDOW_SCHEMA)
    return later_windows(windows, within=False)


@names_apart
def remove_repeats(docs: DataFrame, window: int = WINDOW, cells: int = CELLS) -> DataFrame:
    """`docs` without the words that repeat an earlier document's window; see `removed` in spans."""
    return removed(docs, stage(repeats(docs, window, cells)), window)


def digest(docs: DataFrame, window: int = WINDOW, cells: int = CELLS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    return digest_without(docs, stage(repeats(docs, window, cells)), window)
