"""Alignment of two tokenizers over a corpus.

Documents are brought to their distinct texts by a shuffle of the full text, each with its number of
copies. A distinct text is tokenised and aligned once; its pairs of token ids count for all its
copies, and its measures go back to the doc_ids over the text's SHA-256.

A text is cut before each blank that has a character other than a blank before it and one that is
no white space after it. Both tokenizers cut there (A's pattern takes a blank with what follows,
B has no piece with a blank inside), so such chunks are encoded and aligned by themselves and
remembered. A model for which that can't be shown gets whole texts.

Two tokens are linked where their byte ranges overlap. Between two neighbouring ends of either
tokenizer lies one link, so a group of p and q tokens has p + q - 1.

Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no
tokens: zeros and an empty hash. Equal rows give equal rows; a null doc_id stays null; other columns
of the documents are not looked at. Ties for the highest count all count. Texts of any length are
read in segments of about SEGMENT characters.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import batch_of, map_arrow, stage
from colsight.llm.op3_tokens import byte_names

SEGMENT = 1 << 20  # characters handled at once
REMEMBERED, LONGEST = 300_000, 64  # chunks kept by a task, and their longest
PAIR_LIMIT = 2_000_000  # pairs sent to every task (17 bytes each); more are joined by a shuffle
A_SHIFT, TEXT_SHIFT = 20, 44  # a pair is one number: A id, B id; in a batch, the text above them
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
UNUSUAL = re.compile(r" (?:\s|\Z)")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def read_models(path_a: str | None = None, path_b: str | None = None) -> tuple[str, bytes]:
    """Both tokenizers' files, read by the driver and sent along."""
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return a.read(), b.read()


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, model_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        name = byte_names()
        entries = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        bytes_a = {i: bytes(name[c] for c in token) if all(c in name for c in token) else token.encode() for token, i in entries}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(entries[-1][1] + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        model = sentencepiece_model_pb2.ModelProto.FromString(model_b)
        plain = model.normalizer_spec
        pattern = self.a.pre_tokenizer is not None and "ByteLevel" in repr(self.a.pre_tokenizer) and self.a.normalizer is None
        self.cuts = bool(
            pattern
            and plain.add_dummy_prefix
            and not plain.remove_extra_whitespaces
            and not plain.precompiled_charsmap
            and not model.trainer_spec.treat_whitespace_as_suffix
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        # ids as text with what follows them inside a group, between groups and at a chunk's end
        self.table = [f"{i}{mark}" for mark in ",|" for i in range(len(self.bytes_a))]
        self.table += [f"{i}{mark}" for mark in ",;\n" for i in range(len(self.bytes_b))]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Token ids of chunks that start with the blank B adds by itself."""
        a = [x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        return a, self.b.encode([c[1:] for c in chunks], num_threads=1)


def given_back(chunks: list[str], ids: list[list[int]], tokens: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Which chunks are the bytes of their tokens; compared one by one only where some differ."""
    wanted = [c.encode() for c in chunks]
    flat = list(chain.from_iterable(ids))
    ends = np.cumsum([0, *map(len, ids)])
    size = np.concatenate([[0], np.cumsum(lengths[flat])]) if flat else np.zeros(1, np.int64)
    same = size[ends[1:]] - size[ends[:-1]] == np.fromiter(map(len, wanted), np.int64, len(wanted))
    if same.all() and b"".join(map(tokens.__getitem__, flat)) == b"".join(wanted):
        return same
    return np.array([b"".join(map(tokens.__getitem__, x)) == w for x, w in zip(ids, wanted)], bool)


def flat_ids(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return n, np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))


def put(held: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """`new` written at `at` of the last axis; what is held is copied only when its room is used up, which then doubles."""
    need = at + new.shape[-1]
    if need > held.shape[-1]:
        room = np.empty((*held.shape[:-1], max(need, 2 * held.shape[-1])), held.dtype)
        room[..., :at] = held[..., :at]
        held = room
    held[..., at:need] = new
    return held


def merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The distinct numbers of two sorted arrays, sorted: two runs are merged, nothing is hashed."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return both[np.diff(both, prepend=-1) != 0]


class Chunks:
    """chunk -> number, with the chunk's measures, pairs and groups under that number; in bounded memory."""

    def __init__(self, pair: Pair, limit: int | None = None):
        self.pair, self.limit = pair, limit or REMEMBERED
        self.bad = np.empty(0, bool)  # not given back byte by byte
        self.measures = np.empty((4, 0), np.int64)
        self.pairs, self.starts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_pairs = self.size = 0

    def learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.number]
        if not new:
            return
        pair = self.pair
        ids_a, ids_b = pair.encode(new)
        exact = given_back(new, ids_a, pair.bytes_a, pair.len_a) & given_back(new, ids_b, pair.bytes_b, pair.len_b)
        if not exact.all():
            ids_a, ids_b = ([x if e else [] for x, e in zip(ids, exact)] for ids in (ids_a, ids_b))
        (n_a, a), (n_b, b) = flat_ids(ids_a), flat_ids(ids_b)
        # chunks are aligned one after the other as one run of bytes
        ends_a, ends_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
        ends = merged(ends_a, ends_b)  # one link ends at each
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        closing = (ends_a[at_a] == ends) & (ends_b[at_b] == ends) if len(ends) else np.empty(0, bool)
        of_a, of_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        of_link = of_a[at_a]
        n_groups = np.bincount(of_link[closing], minlength=len(new))
        n_links = np.bincount(of_link, minlength=len(new))
        # groups as text: A's ids, then B's, each with the mark that follows it
        group_a, group_b = np.searchsorted(ends[closing], ends_a), np.searchsorted(ends[closing], ends_b)
        last_a, last_b, last_of_chunk = (np.diff(x, append=-1) != 0 for x in (group_a, group_b, of_b))
        width_a, width_b = len(pair.bytes_a), len(pair.bytes_b)
        codes = np.concatenate([a + width_a * last_a, 2 * width_a + b + width_b * (last_b.astype(np.int64) + last_of_chunk)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        lines = iter("".join(map(pair.table.__getitem__, codes[order].tolist())).split("\n"))
        base = len(self.groups)
        self.number.update(zip(new, range(base, base + len(new))))
        self.groups += [next(lines) if n else "" for n in n_a.tolist()]
        self.bad = put(self.bad, base, ~exact)
        self.measures = put(self.measures, base, np.stack([n_a, n_b, n_groups, n_links]))
        self.starts = put(self.starts, base, np.cumsum(n_links) - n_links + self.n_pairs)
        self.pairs = put(self.pairs, self.n_pairs, (a[at_a] << A_SHIFT) | b[at_b])
        self.n_pairs += len(at_a)
        self.size += sum(map(len, new))

    def pairs_of(self, numbers: np.ndarray) -> np.ndarray:
        """The pairs of these chunks, one after the other."""
        n = self.measures[3][numbers]
        return self.pairs[np.repeat(self.starts[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def tidy(self) -> None:
        """Between texts: start anew when full, and where long chunks have filled it."""
        if len(self.number) > self.limit or self.size > self.limit * LONGEST:
            self.forget()


def segments(text: str, cuts: bool) -> Iterator[list[str]]:
    """Chunks of blank + text, about SEGMENT characters at a time."""
    text = " " + text
    if not cuts:
        yield [text]
        return
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + SEGMENT) if len(text) - at > SEGMENT else None
        to = cut.start() if cut else len(text)
        part = text[at:to]
        if UNUSUAL.search(part):
            start, out = 0, []
            for m in CUT.finditer(part, 1):
                out.append(part[start : m.start()])
                start = m.start()
            yield [*out, part[start:]]
        else:
            yield [" " + x for x in part[1:].split(" ")]
        at = to


def _aligned(texts: DataFrame, path_a: str | None, path_b: str | None) -> DataFrame:
    """(digest, copies, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each distinct text."""

    models = texts.sparkSession.sparkContext.broadcast(read_models(path_a, path_b))

    def make():
        known = Chunks(Pair(*models.value))

        def run(batch):
            if batch is None:
                return []
            values = batch.column("text").to_pylist()
            sums = np.zeros((4, len(values)), np.int64)
            hashes = [hashlib.sha256() for _ in values]
            bad, started = [False] * len(values), [False] * len(values)
            keys: list[np.ndarray] = []
            counts: list[np.ndarray] = []
            block: list[tuple[int, list[str]]] = []
            size = 0

            def flush() -> None:
                known.tidy()
                known.learn(set().union(*(c for _, c in block)))
                found = []
                for t, chunks in block:
                    numbers = np.fromiter(map(known.number.__getitem__, chunks), np.int64, len(chunks))
                    if known.bad[numbers].any():
                        bad[t] = True
                        continue
                    hashes[t].update(((";" if started[t] else "") + ";".join(map(known.groups.__getitem__, numbers.tolist()))).encode())
                    started[t] = True
                    sums[:, t] += known.measures[:, numbers].sum(axis=1)
                    found.append((t << TEXT_SHIFT) | known.pairs_of(numbers))
                if found:
                    k, c = np.unique(np.concatenate(found), return_counts=True)
                    keys.append(k)
                    counts.append(c)
                block.clear()

            for t, text in enumerate(values):
                for chunks in segments(text, known.pair.cuts):
                    block.append((t, chunks))
                    size += sum(map(len, chunks))
                    if size > SEGMENT:
                        flush()
                        size = 0
            flush()
            key = np.concatenate(keys) if keys else np.empty(0, np.int64)
            count = np.concatenate(counts) if counts else np.empty(0, np.int64)
            good = ~np.array(bad, bool)
            key, count = key[good[key >> TEXT_SHIFT]], count[good[key >> TEXT_SHIFT]]
            unique, times = key, count.astype(np.int64)
            if (key[1:] <= key[:-1]).any():  # a text's segments, flushed apart, meet here
                unique, back = np.unique(key, return_inverse=True)
                times = np.bincount(back, count, len(unique)).astype(np.int64)
            offsets = np.searchsorted(unique, np.arange(len(values) + 1, dtype=np.int64) << TEXT_SHIFT).astype(np.int32)
            sums *= good
            digests = ["" if b else h.hexdigest() for b, h in zip(bad, hashes)]
            pairs = pa.ListArray.from_arrays(offsets, pa.array(unique & ((1 << TEXT_SHIFT) - 1)))
            return [
                batch_of(
                    digest=batch.column("digest"), copies=batch.column("copies"), **{m: sums[i] for i, m in enumerate(MEASURES)},
                    groups_sha256=digests, pairs=pairs, times=pa.ListArray.from_arrays(offsets, pa.array(times)),
                )
            ]

        return run

    schema = "digest binary, copies bigint, " + "".join(f"{m} bigint, " for m in MEASURES) + "groups_sha256 string, pairs array<bigint>, times array<bigint>"
    return map_arrow(texts, make, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, is_best): documents that hold the pair linked; is it its A id's most frequent?"""
    counts = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n_docs"))
    counts = stage(counts)
    best = counts.groupBy(F.shiftright("pair", A_SHIFT).alias("a")).agg(F.max("n_docs").alias("best"))
    return counts.join(best, F.shiftright("pair", A_SHIFT) == F.col("a")).select("pair", "n_docs", (F.col("n_docs") == F.col("best")).alias("is_best"))


def _scored_by_table(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Every task holds the pairs; their number has been checked."""
    table = counts.toArrow()
    columns = [table[c].to_numpy() for c in ("pair", "n_docs", "is_best")]
    order = np.argsort(columns[0])
    shared = aligned.sparkSession.sparkContext.broadcast([c[order] for c in columns])

    def make():
        known, n_docs, is_best = shared.value

        def run(batch):
            if batch is None or not batch.num_rows:
                return []
            pairs, times = batch.column("pairs"), batch.column("times")
            offsets = pairs.offsets.to_numpy().astype(np.int64)
            ids, n = pairs.values.to_numpy()[offsets[0] : offsets[-1]], times.values.to_numpy()
            at_times = times.offsets.to_numpy()
            n = n[at_times[0] : at_times[-1]]
            at = np.searchsorted(known, ids) if len(known) else np.empty(0, np.int64)
            offsets -= offsets[0]

            def total(x: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[0], np.cumsum(x)])
                return sums[offsets[1:]] - sums[offsets[:-1]]

            return [batch_of(digest=batch.column("digest"), n_best=total(n * is_best[at]), count_sum=total(n * n_docs[at]))]

        return run

    return map_arrow(aligned.select("digest", "pairs", "times"), make, "digest binary, n_best bigint, count_sum bigint")


def _scored_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    rows = aligned.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("digest", "p.pairs", "p.times")
    return (
        rows.join(counts, F.col("pairs") == F.col("pair"))
        .groupBy("digest")
        .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))
    )


def aligned_texts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Distinct texts with their copies, measures and pairs; each text is tokenised once."""
    text = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    distinct = text.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    return stage(_aligned(keyed, path_a, path_b))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    aligned = aligned_texts(docs, path_a, path_b)
    counts = stage(pair_counts(aligned))
    score = _scored_by_table if counts.count() <= pair_limit else _scored_by_join
    measures = aligned.drop("pairs", "times", "copies").join(score(aligned, counts), "digest", "left")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(F.col("text").cast("string"), 256)).alias("digest"))
    number = [*MEASURES, "n_best", "count_sum"]
    return rows.join(measures, "digest", "left").select(
        "doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in number], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )
