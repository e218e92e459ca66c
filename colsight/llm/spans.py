"""Windows of words that occur earlier, and what documents keep without them.

Shared by the operators that remove repeated passages. A found window is named by half a hash of its seed,
its smallest half-window gram, and a hash of its words: neighbouring windows mostly share the seed and
so meet their equals in the same task, one row a passage comes out and not one a window.
`later_windows` tells which are not the first, `removed` and `digest` apply that to documents.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructType

from colsight.llm.common import NUMBER_ROWS, batch_of, bitmap, grams, has_bit, map_arrow, mix, signed, sliding_min, stage, texts

DOC_BITS = 1 << 25
HALF, HIGH = np.uint64(32), np.uint64(0xFFFFFFFF00000000)
HELD = 700_000  # windows a task holds at once
WINDOW_SCHEMA = "one bigint, two bigint, doc_id bigint, row_key int, known boolean"


def row_key(text: bytes | None) -> int:
    """Tells rows of one doc_id with different texts apart."""
    return xxhash.xxh32_intdigest(text or b"") - (1 << 31)


def seeds_of(hashes: np.ndarray, window: int) -> np.ndarray:
    """The smallest half-window gram of every window."""
    k = max(1, window // 2)
    return sliding_min(mix(grams(hashes, k)), window - k + 1)


def first_rows(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any key."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


class Windows:
    """Windows a task has found; `flush` settles among themselves what it can, so that a window,
    however frequent, leaves a task once (and the others only as known repeats)."""

    def __init__(self, window: int, within: bool):
        self.window, self.within, self.held, self.size = window, within, [], 0

    def add(self, doc: int, text: bytes, hashes: np.ndarray, starts: np.ndarray, all_seeds: np.ndarray | None = None) -> list[pa.RecordBatch]:
        seeds = (seeds_of(hashes, self.window) if all_seeds is None else all_seeds)[starts]
        whole = mix(grams(hashes, self.window)[starts])
        self.held.append((doc, row_key(text), starts, (seeds & HIGH) | (whole >> HALF), whole & ~HIGH))
        self.size += len(starts)
        return self.flush() if self.size > HELD else []

    def flush(self) -> list[pa.RecordBatch]:
        if not self.held:
            return []
        lengths = [len(h[2]) for h in self.held]
        doc = np.repeat(np.array([h[0] for h in self.held], np.int64), lengths)
        key = np.repeat(np.array([h[1] for h in self.held], np.int32), lengths)
        start, one, two = (np.concatenate([h[i] for h in self.held]) for i in (2, 3, 4))
        self.held, self.size = [], 0
        order = np.lexsort((start, doc, two, one))
        doc, key, start, one, two = (x[order] for x in (doc, key, start, one, two))
        first = first_rows(one, two)
        known = _later(doc, start, *(x[first][np.cumsum(first) - 1] for x in (doc, start)), self.within)
        second = (two << HALF) | start.astype(np.uint64)
        spread = np.where(known, (mix(doc.astype(np.uint64) + (one & HIGH)) & HIGH) | (one & ~HIGH), one)
        return [batch_of(one=signed(spread), two=signed(second), doc_id=pa.array(doc), row_key=pa.array(key), known=pa.array(known))]


def _later(doc, start, least_doc, least_start, within: bool):
    return (doc > least_doc) | ((doc == least_doc) & (start > least_start)) if within else doc > least_doc


def later_windows(windows: DataFrame, within: bool) -> DataFrame:
    """(doc_id, row_key, starts) of windows that start in an earlier document too or, with
    `within`, earlier in the same one. `starts` is text of little-endian 32-bit numbers."""

    def make():
        last: list = [None, None, None, None]  # window, its first document and start, across batches

        def run(batch):
            if batch is None:
                return []
            one, two, doc, key, known = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            word, start = two.view(np.uint64) >> np.uint64(32), (two & 0xFFFFFFFF).astype(np.int64)
            new = first_rows(one, word) | known
            new[1:] |= known[:-1]
            group = np.cumsum(new) - 1
            least_doc, least_start = doc[new][group], start[new][group]
            if not known[0] and (one[0], word[0]) == (last[0], last[1]):
                least_doc[group == 0], least_start[group == 0] = last[2], last[3]
            if not known[-1]:
                last[:] = [one[-1], word[-1], least_doc[-1], least_start[-1]]
            out = known | _later(doc, start, least_doc, least_start, within)
            if not out.any():
                return []
            doc, key, start = doc[out], key[out], start[out].astype("<u4")
            order = np.lexsort((start, key, doc))
            doc, key, start = doc[order], key[order], start[order]
            at = np.flatnonzero(first_rows(doc, key))
            coded = [base64.b64encode(start[a:b].tobytes()).decode() for a, b in zip(at, [*at[1:], len(doc)])]
            return [batch_of(doc_id=pa.array(doc[at]), row_key=pa.array(key[at]), starts=pa.array(coded, pa.string()))]

        return run

    ordered = windows.repartition(F.shiftright("one", 32).alias("seed")).sortWithinPartitions("one", "known", F.shiftrightunsigned("two", 32), "doc_id", "two")
    return gathered(map_arrow(ordered, make, "doc_id bigint, row_key int, starts string", rows=NUMBER_ROWS))


def gathered(parts: DataFrame) -> DataFrame:
    """One row a document; its numbers are at most as many as its words."""
    return parts.groupBy("doc_id", "row_key").agg(F.array_join(F.collect_list("starts"), ",").alias("starts"))


def numbers(coded: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(base64.b64decode(p), "<u4") for p in coded.split(",")]).astype(np.int64)


def _kept(words: list[bytes], coded: str, window: int) -> list[bytes]:
    starts = numbers(coded)
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, len(words)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone) if not g]


def split(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents surely not in `found(doc_id, row_key, starts)`, and the others with their `starts`.

    Which is which is told by a bitmap of fixed size over doc_id; the join settles its errors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(found, F.xxhash64("doc_id"), DOC_BITS))

    def marked(wanted: bool):
        def make():
            def run(batch):
                if batch is None:
                    return []
                hit = has_bit(shared.value, batch.column("__place").to_numpy()) == wanted
                return [batch.filter(pa.array(hit)).drop_columns(["__place"])] if hit.any() else []

            return run

        placed = docs.withColumn("__place", F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(DOC_BITS)))
        return map_arrow(placed, make, docs.schema)

    names = found.select(F.col("doc_id").alias("__doc"), F.col("row_key").alias("__found"), F.col("starts").alias("__starts"))
    mine = (F.col("doc_id").cast("bigint") == F.col("__doc")) & (F.col("__key") == F.col("__found"))
    return marked(False), _with_key(marked(True)).join(names, mine, "left").select(*docs.columns, "__starts")


def removed(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """`docs` without the words that the found windows cover: kept words joined by one space where
    anything was removed, unchanged elsewhere. Documents left without words go. `n_chars`, if
    there, follows the text."""
    clean, hit = split(docs, found)
    columns = docs.columns

    def make():
        def run(batch):
            if batch is None:
                return []
            out = []
            for text, starts in zip(texts(batch), batch.column("__starts").to_pylist()):
                out.append(text if starts is None else b" ".join(_kept(text.split(), starts, window)))
            changed = pa.array([None if t is None else t.decode() for t in out], pa.string())
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", changed)
            whole = pa.array([s is None or bool(t) for s, t in zip(batch.column("__starts").to_pylist(), out)])
            return [batch.filter(whole).select(columns)]

        return run

    cut = map_arrow(hit, make, docs.schema)
    out = clean.unionByName(cut)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _with_key(docs: DataFrame) -> DataFrame:
    """Adds `__key`, the row key of the text."""

    def make():
        def run(batch):
            if batch is None:
                return []
            return [batch.append_column("__key", pa.array([row_key(t) for t in texts(batch)], pa.int32()))]

        return run

    return map_arrow(docs, make, StructType([*docs.schema.fields]).add("__key", IntegerType()))


def digest(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""

    def make():
        def run(batch):
            if batch is None:
                return []
            rows = []
            coded = batch.column("__starts").to_pylist() if "__starts" in batch.schema.names else [None] * batch.num_rows
            for text, starts in zip(texts(batch), coded):
                words = text.split() if text else []
                left = words if starts is None else _kept(words, starts, window)
                rows.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            n, gone, sha = zip(*rows)
            return [batch_of(doc_id=batch.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()), kept_sha256=pa.array(sha, pa.string()))]

        return run

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    clean, hit = split(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), found)
    return map_arrow(clean, make, schema).unionByName(map_arrow(hit, make, schema))
