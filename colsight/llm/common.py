"""Helpers of the operators: words, hashes, bitmaps of fixed size, runs of a sorted stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from colsight.plans.staging import stage  # noqa: F401

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: splitmix64
ROLL = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def names_apart(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions that return rows of their first argument with all its columns: while they work, columns
    but doc_id, text and n_chars have names that clash with nothing, in the result their own again."""

    @wraps(work)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = docs.columns
        own = [n if n in ("doc_id", "text", "n_chars") and names.index(n) == i else f"column_{i}" for i, n in enumerate(names)]
        return work(docs.toDF(*own), *args, **options).toDF(*names)

    return run


def text_hash() -> Column:
    """64-bit hash of the column `text`, which with doc_id names a row."""
    return F.xxhash64(F.col("text").cast("string"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The column's values as UTF-8."""
    return batch.column(column).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """word -> 64-bit hash, remembered; forgets all when full, so memory stays bounded."""

    def __init__(self, limit: int = 150_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, k: int, base: int = ROLL) -> np.ndarray:
    """Polynomial hash of every k consecutive words, by doubling lengths."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, block, length = None, 0, hashes, 1
    while True:
        if k & length:
            part = block[done : done + n]
            out = part if out is None else out * np.uint64(pow(base, length, 1 << 64)) + part
            done += length
        if length * 2 > k:
            return out
        block = block[:-length] * np.uint64(pow(base, length, 1 << 64)) + block[length:]
        length *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive numbers."""
    length = 1
    while length * 2 <= w:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    return x if length == w else np.minimum(x[: len(x) - (w - length)], x[w - length :])


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; all words as one if there are fewer; none of no words."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(mix(grams(hashes, min(k, len(hashes))) + np.uint64(min(k, len(hashes)))))


def lower_words(text: bytes | None) -> list[bytes]:
    """ASCII-lower-cased runs of anything but ASCII white space."""
    return text.lower().split() if text else []


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def bitmap(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """Bit `key mod bits` set for every row. Always `bits / 8` bytes, whatever the input."""
    position = F.pmod(key, F.lit(bits)) + 1  # Spark's bitmaps count from 1
    rows = (
        keys.select(position.alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bytes"))
        .toLocalIterator()
    )
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in rows:  # at most bits / 32768 rows
        start = (row["bucket"] - 1) * 4096
        part = np.frombuffer(bytes(row["bytes"]), np.uint8)
        out[start : start + len(part)] |= part
    return out


def set_apart(docs: DataFrame, named: DataFrame, bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """`docs` in two: rows that `named(__doc, __text)` surely doesn't hold by doc_id and `text_hash`, and the rest, which
    are those it holds and few others, so that a join with it need not shuffle all texts. What is broadcast
    is a bitmap of at most bits / 64 numbers, whatever the input; when full, it keeps nothing apart."""

    def place(doc: Column, text: Column) -> Column:
        return F.pmod(F.xxhash64(doc.cast("bigint"), text), F.lit(bits))

    named = named.select(place(F.col("__doc"), F.col("__text")).alias("at"))
    marks = named.groupBy(F.shiftright("at", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("__bits"))
    at = place(F.col("doc_id"), text_hash())
    marked = docs.join(F.broadcast(stage(marks)), F.shiftright(at, 6) == F.col("__word"), "left")
    hit = F.coalesce(F.getbit("__bits", (at % 64).cast("int")), F.lit(0)) == 1
    return marked.where(~hit).select(docs.columns), marked.where(hit).select(docs.columns)


def has_bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from a stream sorted by `keys`; only the last, open group waits."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = key(batch, batch.num_rows - 1)
        low, high = 0, batch.num_rows - 1  # first row of the last group
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if key(batch, middle) == last else (middle + 1, high)
        if held and (low > 0 or key(held[0], 0) != last):
            if key(held[0], 0) != key(batch, 0):
                yield pa.Table.from_batches(held)
                held = []
            if low:
                held.append(batch.slice(0, low))
                yield pa.Table.from_batches(held)
            held = []
        elif not held and low:
            yield pa.Table.from_batches([batch.slice(0, low)])
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS, NUMBER_ROWS = 256, 100_000


def sized(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `rows`."""
    held: list[pa.RecordBatch] = []
    n = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            n += held[-1].num_rows
            if 2 * n >= rows:
                yield joined()
                held, n = [], 0
    if n:
        yield joined()


def map_arrow(df: DataFrame, make: Callable[[], Callable], schema, rows: int = TEXT_ROWS) -> DataFrame:
    """`make()` runs once a task and gives the function of one batch, called with None at the end.

    The function returns a list of record batches. It gets about `rows` rows at a time: few where
    they hold texts, so that texts, words and results of many rows are never held together. Spark's
    own batches of 10,000 rows are cut to 1,000 unless the session says otherwise.
    """
    if df.sparkSession.conf.get(BATCH) == "10000":
        df.sparkSession.conf.set(BATCH, "1000")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = make()
        for batch in sized(batches, rows):
            yield from run(batch)
        yield from run(None)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return df.mapInArrow(task, schema)


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))
