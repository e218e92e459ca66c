"""Removal of repeated passages by a sparse suffix array.

Of all suffixes (a text from some word on) only those that start at a minimiser are kept: the
place of the smallest `gram`-word gram among the first `spread` of a window. It depends on the
window's words alone, so two copies of a window keep the same suffix, which starts early enough
to share `window - spread + 1` words with its copy. The suffixes are sorted by a hash of that
many words; neighbours that agree are matches. Matches are then extended word by word to the
left, as far as windows have that suffix, and to the right up to `window` words, each extension
named by its hash, and the sorted extensions tell which passages occurred earlier (a smaller doc_id, or an earlier place in the same document).
Every word under a window that occurred earlier is removed; the first occurrence stays.

A suffix or extension that is frequent leaves a task once. Words are runs of anything but ASCII
white space, unchanged. Null, empty and shorter texts lose nothing; rows without doc_id neither
lose nor remove anything; of rows with equal doc_id and text neither is earlier.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import NUMBER_ROWS, WordHashes, batch_of, grams, map_arrow, mix, names_apart, signed, stage, texts
from colsight.llm.spans import WINDOW_SCHEMA, Windows, first_rows, gathered, later_windows, numbers, row_key, split
from colsight.llm.spans import digest as digest_without, removed

WINDOW, SPREAD, GRAM = 50, 18, 8
HELD = 1_000_000  # suffixes a task holds at once


def minimisers(hashes: np.ndarray, window: int, spread: int, gram: int) -> np.ndarray:
    """For every window of a text the place of its kept suffix: the first smallest gram among its
    first `spread`. It depends on nothing outside the window."""
    g = mix(grams(hashes, gram))
    at, length = np.arange(len(g)), 1
    while length < spread:
        step = min(length, spread - length)
        left, right = at[:-step], at[step:]
        at, length = np.where(g[left] <= g[right], left, right), length + step
    return at[: len(hashes) - window + 1]


def suffixes(docs: DataFrame, window: int, spread: int, gram: int) -> DataFrame:
    """(key, doc_id, row_key, at, known): kept suffixes by the hash of their first words; `known`
    if the task has met the key already, in which case the key is free to be anything."""
    length = window - spread + 1

    def make():
        memo, held = WordHashes(), []

        def flush():
            if not held:
                return []
            lengths = [len(h[2]) for h in held]
            doc = np.repeat(np.array([h[0] for h in held], np.int64), lengths)
            row = np.repeat(np.array([h[1] for h in held], np.int32), lengths)
            at, key = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            held.clear()
            order = np.lexsort((at, row, doc, key))
            doc, row, at, key = doc[order], row[order], at[order], key[order]
            new = first_rows(key)
            twice = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1  # neighbours agree
            known = twice & ~new
            spreading = np.where(known, mix(key + at.astype(np.uint64) + doc.astype(np.uint64)), key)
            return [batch_of(key=signed(spreading), doc_id=pa.array(doc), row_key=pa.array(row), at=pa.array(at.astype(np.int32)), known=pa.array(known), met=pa.array(twice))]

        def run(batch):
            if batch is None:
                return flush()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = text.split() if text else []
                if len(words) >= window:
                    hashes = memo.of(words)
                    prefix = grams(hashes, length)
                    at = np.unique(minimisers(hashes, window, spread, gram))
                    held.append((doc, row_key(text), at, mix(prefix[at])))
            return flush() if sum(len(h[2]) for h in held) > HELD else []

        return run

    return map_arrow(docs.where(F.col("doc_id").isNotNull()), make, "key bigint, doc_id bigint, row_key int, at int, known boolean, met boolean")


def matches(rows: DataFrame) -> DataFrame:
    """(doc_id, row_key, starts): places of suffixes that agree with a neighbour in the sorted order."""

    def make():
        held: list = []  # the last row of the batch before, if its match is open

        def give(doc, row, at):
            order = np.lexsort((at, row, doc))
            doc, row, at = doc[order], row[order], at[order].astype("<u4")
            ends = np.flatnonzero(first_rows(doc, row))
            coded = [base64.b64encode(at[a:b].tobytes()).decode() for a, b in zip(ends, [*ends[1:], len(doc)])]
            return [batch_of(doc_id=pa.array(doc[ends]), row_key=pa.array(row[ends]), starts=pa.array(coded, pa.string()))]

        def run(batch):
            if batch is None:
                return []
            key, doc, row, at, known, met = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            out = known | met
            same = (key[1:] == key[:-1]) & ~known[1:] & ~known[:-1]
            out[1:] |= same
            out[:-1] |= same
            extra = None
            if held and not known[0] and held[0] == key[0]:
                out[0] = True
                extra = None if held[4] else held[1:4]
            held[:] = [] if known[-1] else [key[-1], doc[-1], row[-1], at[-1], bool(out[-1])]
            doc, row, at = doc[out], row[out], at[out]
            if extra:
                doc, row, at = np.append(doc, extra[0]), np.append(row, extra[1]).astype(np.int32), np.append(at, extra[2])
            return give(doc, row, at) if len(doc) else []

        return run

    ordered = rows.repartition("key").sortWithinPartitions("key", "known", "doc_id", "at")
    return gathered(map_arrow(ordered, make, "doc_id bigint, row_key int, starts string", rows=NUMBER_ROWS))


def repeats(docs: DataFrame, window: int = WINDOW, spread: int = SPREAD, gram: int = GRAM) -> DataFrame:
    """(doc_id, row_key, starts): windows that occurred earlier."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = stage(matches(suffixes(docs, window, spread, gram)))
    _, hit = split(docs, found)

    def make():
        memo, out = WordHashes(), Windows(window, within=True)

        def run(batch):
            if batch is None:
                return out.flush()
            given = []
            for doc, text, coded in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("__starts").to_pylist()):
                if coded is None:
                    continue
                hashes = memo.of(text.split())
                matched = np.zeros(len(hashes), bool)
                matched[numbers(coded)] = True
                starts = np.flatnonzero(matched[minimisers(hashes, window, spread, gram)])
                if len(starts):
                    given += out.add(doc, text, hashes, starts)
            return given

        return run

    return later_windows(map_arrow(hit, make, WINDOW_SCHEMA), within=True)


@names_apart
def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """`docs` without repeated passages; see `removed` in spans."""
    return removed(docs, stage(repeats(docs, **options)), options.get("window", WINDOW))


def digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    return digest_without(docs, stage(repeats(docs, **options)), options.get("window", WINDOW))
