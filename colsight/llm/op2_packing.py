"""Best-fit packing certified by lower bounds.

Documents are tokenised where they are read; only (row, piece, length) is packed, in groups
of bounded size. In each group a dual-feasible function bounds the number of sequences from
below: best-fit decreasing that meets the bound, and the group's part of the bound of all
documents, is certified and keeps its sequences but the emptiest, which rounding leaves open. A
group with a gap gives up all its sequences.
What is given up is exchanged: dealt anew to fewer, larger groups and packed again, until one
group is left or groups have reached the memory of a task.

Null or empty texts are one end token. A row is packed as often as it occurs. Whole pieces of
`capacity` tokens fill a sequence each and are never moved.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import batch_of, map_arrow, runs, stage, texts

CAPACITY = 2048
GROUP_PIECES = 60_000  # pieces a packing task holds: memory of a task, not a limit on the input
FAN_IN = 32


# fixed values: what a tokenizer must do for chunks of Latin text to go straight to its merges
NORMALIZERS, WORDS = ("NFC", "Replace", "Lowercase"), r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")  # WORDS in lower-case ASCII without white space
PRINTED = bytes(range(33, 127))
LATIN = re.compile(rb"(?:[\x21-\x7e]|\xc3[\x80-\xbf]|[\xc4\xc5](?!\xb0)[\x80-\xbf])+")  # NFC already, lower case letter by letter


class ChunkIds(dict):
    """Chunk without ASCII white space -> its ids as little-endian bytes, in bounded memory.

    Exact for tokenizers that never join text across white space, as `word_bpe_49k` (checked
    by the tests against whole texts). If the tokenizer normalises and cuts words as that one
    does, Latin chunks are cut here and only merged by its model, which is several times
    faster; all other chunks go through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str, dtype: str = "<u4", limit: int = 400_000):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype, self.limit, self.words = dtype, limit, {}
        steps = tuple(x["type"] for x in (spec["normalizer"] or {}).get("normalizers", ()))
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.direct = steps == NORMALIZERS and cuts[0].get("pattern") == {"Regex": WORDS} and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        self.packed = [i.to_bytes(np.dtype(dtype).itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.tokenize = self.tokenizer.model.tokenize
        self.find = regex.compile(WORDS).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes named by their own character
        rest = [x for x in range(256) if x not in plain]
        self.names = {x: chr(256 + i) for i, x in enumerate(rest)}

    def _word(self, word: bytes) -> bytes:
        """Ids of a lower-case word, an entry of `words` from now on."""
        if len(self.words) >= self.limit:
            self.words.clear()
        named = word.decode() if word.isascii() else word.decode("latin-1").translate(self.names)
        packed = self.packed
        ids = self.words[word] = b"".join([packed[t.id] for t in self.tokenize(named)])
        return ids

    def _ids(self, chunk: bytes) -> bytes:
        if self.direct:
            low = chunk.lower()
            if low.isalpha():  # ASCII letters only
                return self.words.get(low) or self._word(low)
            if b"<|" not in chunk:
                if not low.translate(None, PRINTED):
                    words = ASCII_WORDS.findall(low)
                elif LATIN.fullmatch(chunk):
                    text = chunk.decode().lower()
                    words = [w.encode() for w in ([text] if text.isalpha() else self.find(text))]
                else:
                    words = None
                if words is not None:
                    return b"".join([self.words.get(w) or self._word(w) for w in words])
        return np.array(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[chunk] = self._ids(chunk)
        return ids

    def of(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, text.split())) if text else b""


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer's file, read by the driver and sent along (its size is the file's)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text: its ids and an end id, cut
    into pieces of `capacity` if longer. `ids` are little-endian unsigned 32-bit numbers."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        known = ChunkIds(tokenizer)

        def run(batch):
            if batch is None:
                return []
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = known.of(text) + end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part), part))
            doc, i, at, n, crc, part = zip(*rows)
            out = dict(doc_id=pa.array(doc, pa.int64()), piece=pa.array(i, pa.int32()), start=pa.array(at, pa.int64()), length=pa.array(n, pa.int64()), ids_crc32=pa.array(crc, pa.int64()))
            return [batch_of(**out, ids=pa.array(part, pa.binary()))] if with_ids else [batch_of(**out)]

        return run

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), make, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, from the number of items of each size 0..capacity: the best of the dual-feasible functions u^(k), which
    round sizes on a grid, and f0, which drops small sizes and rounds large ones up."""
    size = np.arange(capacity + 1)
    best = -(-int((counts * size).sum()) // capacity)
    for k in range(1, 33):  # u^(k): x(k+1) integral -> x, else floor(x(k+1))/k
        grid = size * (k + 1)
        exact = grid % capacity == 0
        worth = np.where(exact, size * k, grid // capacity * capacity)
        best = max(best, -(-int((counts * worth).sum()) // (capacity * k)))
    total = (counts * size).sum()
    below, n_above = np.cumsum(counts * size), np.cumsum(counts[::-1])[::-1]
    for small in range(1, capacity // 2 + 1):  # f0: size > C - small -> C, size < small -> 0
        large = capacity - small + 1
        middle = int(below[large - 1] - below[small - 1]) if large > small else 0
        best = max(best, int(n_above[large]) - (-middle // capacity)) if large <= capacity else best
    return best if total else 0


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every size, and the number of bins. `free` holds the open bins by the
    room they have; bit r of `rooms` says that some bin has room r."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = n_bins = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            free[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, n_bins


def global_share(items: DataFrame, capacity: int) -> float:
    """Lower bound of all items together, per token. The histogram has at most `capacity` rows."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    tokens = int((counts * np.arange(capacity + 1)).sum())
    return lower_bound(counts, capacity) / tokens if tokens else 0.0


def _pack_round(items: DataFrame, groups: int, capacity: int, number: int, last: bool, share: float) -> DataFrame:
    """Items with `sequence_id` and `offset`; null where a sequence was released."""

    def task(batches):
        for table in runs(batches, ["grp"]):
            sizes = table.column("length").to_numpy()
            bins, offsets, n = best_fit_decreasing(sizes, capacity)
            filled = np.bincount(bins, sizes, n).astype(np.int64)
            bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
            gap = n > bound or n - share * sizes.sum() >= 1  # over its own bound, or over its part of everyone's
            if last:
                released = np.zeros(n, bool)
            elif gap:  # all documents go to a larger group: what is missing may sit in full sequences
                released = np.ones(n, bool)
            else:  # certified; only what rounding leaves open
                released = np.zeros(n, bool)
                released[np.argmin(filled)] = filled.min() < capacity
            out = released[bins]
            group = table.column("grp")[0].as_py()
            ids = (np.int64(number) << 56) + (np.int64(group) << 28) + bins
            names = [c for c in table.column_names if c not in ("grp", "sequence_id", "offset")]
            table = table.select(names).combine_chunks()
            for batch in table.append_column("sequence_id", pa.array(ids, mask=out)).append_column("offset", pa.array(offsets, mask=out)).to_batches():
                yield batch

    keep = [f for f in items.schema.fields if f.name not in ("sequence_id", "offset")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", sequence_id bigint, offset bigint"
    group = F.pmod(F.xxhash64(F.lit(number), "row_id"), F.lit(groups)) if groups > 1 else F.lit(0).cast("bigint")
    dealt = items.select(*(f.name for f in keep)).withColumn("grp", group)
    return dealt.repartition(groups, "grp").sortWithinPartitions("grp").mapInArrow(task, schema)


def pack(items: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to `items(..., length)`, lengths 1 to `capacity`.

    One job a round. Groups shrink by FAN_IN, so rounds grow with the logarithm of the input;
    a round that can't shrink them within the memory of a task is the last.
    """
    items = stage(items.withColumn("row_id", F.monotonically_increasing_id()))
    whole = F.col("length") == capacity
    full = items.where(whole).withColumn("sequence_id", F.col("row_id") - F.lit(1 << 62)).withColumn("offset", F.lit(0).cast("bigint"))
    left, done, number = items.where(~whole), [full], 0
    count = left.count()
    groups = max(1, -(-count // group_pieces))
    share = global_share(left, capacity) if groups > 1 else 0.0
    while count:
        fewer = max(groups // FAN_IN, -(-count // (4 * group_pieces)), 1)
        last = groups == 1 or (number > 0 and fewer >= groups)
        packed = stage(_pack_round(left, groups, capacity, number, last, share))
        done.append(packed.where(F.col("sequence_id").isNotNull()))
        left = packed.where(F.col("sequence_id").isNull())
        count = 0 if last else left.count()
        number += 1
        groups = min(groups, max(groups // FAN_IN, -(-count // (4 * group_pieces)), 1))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("row_id")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack(pieces(docs, tokenizer_json(tokenizer_path), capacity, with_ids=with_ids), capacity)
