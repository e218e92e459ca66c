"""Language identification with bit-sliced Bloom filters of n-grams.

Training counts the character n-grams of the words of each language, over all training rows.
A language's set holds the n-grams whose rate in it is at least MIN_RATE and at least SHARE of
the highest rate in any language; so it has at most 1 / MIN_RATE members for each length,
whatever the corpus. All sets share one Bloom filter whose cells are bitmasks of languages: the
AND of an n-gram's cells gives every language containing it in one lookup.

N-grams of all texts of a batch are read at once, as rolling hashes over code points; a hash
of 64 bits stands for its n-gram. A text's n-grams vote for all their languages. False positives are expected at a rate that
follows from how full a language's slice is, and are subtracted before the counts are compared.

Words are runs of letters, lower-cased; n-grams include the ends of words but don't cross them. A text that is null or has no letter is `und` with score
0, as is every text if nothing was learned. Rows with null doc_id, lang or text teach nothing;
ties between languages go to the first by name. The score is the winner's share of all votes
left after the correction.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from colsight.llm.common import ROLL, batch_of, map_arrow, mix, signed, stage

LENGTHS = (2, 3, 4)
MIN_RATE = 2e-5
SHARE = 0.4
CELL_BITS, HASHES = 22, 2  # 2^22 cells; a hash is 22 of an n-gram's 64 bits
MASK_BITS = 8  # languages in one mask; more languages use more masks
HELD = 4_000_000  # n-grams a task holds at once


def letter_table() -> np.ndarray:
    """Whether each code point is a letter, packed."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def read_grams(texts: list[str | None], letters: np.ndarray):
    """(letters of every text, [(n-gram hashes, their text's number) for each length]).

    Code points other than letters become 0, runs of them one 0, and every text is between two:
    an n-gram is valid if it has letters everywhere but at its ends.
    """
    padded = [f"\n{(t or '').lower()}\n" for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in padded])
    letter = letters[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    codes, owner, letter = np.where(letter, codes, 0)[kept].astype(np.uint64), owner[kept], letter[kept]
    counts = np.bincount(owner[letter], minlength=len(texts))
    out = []
    for n in LENGTHS:
        size = len(codes) - n + 1
        if size <= 0:
            out.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
            continue
        h = np.full(size, n, np.uint64)
        inside = np.ones(size, bool)
        for i in range(n):
            h = h * np.uint64(ROLL) + codes[i : i + size]
            if 0 < i < n - 1:
                inside &= letter[i : i + size]
        out.append((mix(h[inside]), owner[1 : 1 + size][inside]))
    return counts, out


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, length, gram, n) of `rows(lang, text)`; a task sends each n-gram once a flush."""
    packed = letter_table()

    def make():
        letters = np.unpackbits(packed).astype(bool)
        held: dict[tuple[str, int], list[np.ndarray]] = {}
        state = {"size": 0}

        def flush():
            out = []
            for (lang, n), parts in held.items():
                gram, count = np.unique(np.concatenate(parts), return_counts=True)
                out.append(batch_of(lang=pa.array([lang] * len(gram), pa.string()), length=pa.array(np.full(len(gram), n, np.int32)), gram=signed(gram), n=pa.array(count)))
            held.clear()
            state["size"] = 0
            return out

        def run(batch):
            if batch is None:
                return flush()
            langs = np.array(batch.column("lang").to_pylist(), object)
            _, grams = read_grams(batch.column("text").to_pylist(), letters)
            for n, (h, owner) in zip(LENGTHS, grams):
                whose = langs[owner]
                for lang in set(langs):
                    held.setdefault((lang, n), []).append(h[whose == lang])
                state["size"] += len(h)
            return flush() if state["size"] > HELD else []

        return run

    counted = map_arrow(rows.select(F.col("lang").cast("string"), F.col("text").cast("string")), make, "lang string, length int, gram bigint, n bigint")
    return counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


class Filter:
    """Cells of language masks, and per language the rate of false positives."""

    def __init__(self, languages: list[str], cells: np.ndarray):
        self.languages, self.cells = languages, cells
        full = [self.bit(cells, i).mean() if len(languages) else 0.0 for i in range(len(languages))]
        self.false = np.array(full) ** HASHES

    @staticmethod
    def bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // MASK_BITS] >> np.uint8(i % MASK_BITS)) & np.uint8(1)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram: the AND of its cells."""
        out = None
        for i in range(HASHES):
            cell = self.cells[(grams >> np.uint64(CELL_BITS * i) & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)]
            out = cell if out is None else out & cell
        return out

    def votes(self, grams: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """(texts, 1 + languages): n-grams of each text, and how many of them each language contains.
        `owner` ascends."""
        edges = np.searchsorted(owner, np.arange(texts + 1))
        masks = self.masks(grams)
        out = np.empty((texts, 1 + len(self.languages)))
        out[:, 0] = np.diff(edges)
        for i in range(len(self.languages)):
            total = np.concatenate([[0], np.cumsum(self.bit(masks, i), dtype=np.int64)])
            out[:, i + 1] = total[edges[1:]] - total[edges[:-1]]
        return out


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and filter cells from `rows(lang, text)`."""
    counts = stage(gram_counts(rows))
    totals = counts.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    languages = sorted(r[0] for r in totals.select("lang").distinct().collect())
    out = np.zeros((1 << CELL_BITS, max(1, -(-len(languages) // MASK_BITS))), np.uint8)
    if not languages:
        return [], out
    rates = counts.join(totals, ["lang", "length"]).withColumn("rate", F.col("n") / F.col("total")).where(F.col("rate") >= MIN_RATE)
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
    chosen = rates.join(best, "gram").where(F.col("rate") >= SHARE * F.col("best"))
    place = (F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1).cast("int")
    at = [F.shiftrightunsigned("gram", CELL_BITS * i).bitwiseAND(F.lit((1 << CELL_BITS) - 1)) for i in range(HASHES)]
    cells = (
        chosen.select(F.explode(F.array(*at)).alias("cell"), place.alias("place"))
        .select("cell", F.floor(F.col("place") / MASK_BITS).cast("int").alias("word"), F.expr(f"shiftleft(1, place % {MASK_BITS})").alias("bit"))
        .groupBy("cell", "word")
        .agg(F.bit_or("bit").alias("mask"))
    )
    for row in cells.toLocalIterator():  # at most HASHES / MIN_RATE rows for each language and length
        out[row["cell"], row["word"]] = row["mask"]
    return languages, out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from nothing but its text."""
    shared = docs.sparkSession.sparkContext.broadcast((*model, letter_table()))

    def make():
        languages, cells, packed = shared.value
        letters, filter_ = np.unpackbits(packed).astype(bool), Filter(languages, cells)

        def run(batch):
            if batch is None:
                return []
            n = batch.num_rows
            counts, grams = read_grams(batch.column("text").to_pylist(), letters)
            votes = sum(filter_.votes(h, owner, n) for h, owner in grams)
            real = np.maximum(votes[:, 1:] - votes[:, :1] * filter_.false, 0) / np.maximum(1 - filter_.false, 1e-3)
            total = real.sum(axis=1) if languages else np.zeros(n)
            first = real.argmax(axis=1) if languages else np.zeros(n, int)
            known = (counts > 0) & (votes[:, 0] > 0) & bool(languages)
            pred = [languages[i] if k else "und" for i, k in zip(first, known)]
            top = real[np.arange(n), first] if languages else np.zeros(n)
            score = np.where(known & (total > 0), top / np.where(total > 0, total, 1), 0.0)
            return [batch_of(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), lang_pred=pa.array(pred, pa.string()), score=pa.array(score))]

        return run

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return map_arrow(rows, make, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); learns from rows that aren't held out."""
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(docs, learn(known))
