"""Token-id output: documents packed best-fit decreasing into rows of fixed width.

A task tokenises its documents where it reads them, cuts long ones into pieces without losing a
token, and packs a buffer of bounded size at a time, so nothing is shuffled. The open row with
the least sufficient room is found in a segment tree over capacities, in time logarithmic in
the width. A row of the result is a row of the id matrix with what a trainer needs to keep its
documents apart: cumulative segment lengths and, for every segment, the place where positions
start anew (`resets`) and the position they start from in its document (`starts`).

Null and empty texts are one end token. Repeated rows are packed each; of equal lengths the
earlier row comes first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import batch_of, map_arrow, texts
from colsight.llm.op2_packing import ChunkIds, tokenizer_json

WIDTH = 2048
BUFFER_TOKENS = 12_000_000  # ids a task holds at once: memory of a task, not a limit


class CapacityTree:
    """Bins by the room they have left. A node counts the bins whose room is in its range."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, room: int, b: int) -> None:
        self.bins[room].append(b)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and bin of the bin with the least room that is at least `need`."""
        node = need + self.size
        while not self.count[node]:  # up and to the right, to the next range with a bin
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            if node == 1 or node & (node - 1) == 0:
                return None
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        b = self.bins[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, b


def best_fit_decreasing(sizes: np.ndarray, width: int) -> list[list[int]]:
    """Indices of the sizes in every bin, in the order they were put."""
    tree, bins = CapacityTree(width), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size) if size < width else None
        room, b = found if found else (width, len(bins))
        if not found:
            bins.append([])
        bins[b].append(i)
        if room > size:
            tree.put(room - size, b)
    return bins


def packed_rows(docs: DataFrame, tokenizer_path: str | None = None, width: int = WIDTH, end_id: int = 0, pad_id: int = 0) -> DataFrame:
    """(n_tokens, doc_ids, pieces, starts, cu_seqlens, resets, ids) for every packed row.

    `ids` are `width` little-endian unsigned numbers, padded with `pad_id`: of 16 bits if the
    vocabulary fits, of 32 otherwise. `cu_seqlens` has one entry more than there are segments.
    """
    tokenizer = tokenizer_json(tokenizer_path)
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    end, step = np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize

    def make():
        known = ChunkIds(tokenizer, dtype)
        held: list[tuple] = []  # doc, piece, start, ids

        def flush():
            if not held:
                return []
            sizes = np.array([len(h[3]) // step for h in held])
            rows = []
            for members in best_fit_decreasing(sizes, width):
                segments = [held[i] for i in members]
                ends = np.cumsum(sizes[members])
                ids = b"".join(s[3] for s in segments)
                ids += np.full(width - int(ends[-1]), pad_id, dtype).tobytes()
                rows.append((int(ends[-1]), [s[0] for s in segments], [s[1] for s in segments], [s[2] for s in segments], [0, *ends.tolist()], [0, *ends[:-1].tolist()], ids))
            held.clear()
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
            names = ("n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens", "resets", "ids")
            return [batch_of(**{n: pa.array(c, k) for n, c, k in zip(names, zip(*rows[at : at + 1000]), kinds)}) for at in range(0, len(rows), 1000)]

        size = 0

        def run(batch):
            nonlocal size
            if batch is None:
                return flush()
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = known.of(text) + end
                for i, at in enumerate(range(0, len(ids), step * width)):
                    held.append((doc, i, at // step, ids[at : at + step * width]))
                size += len(ids) // step
                if size > BUFFER_TOKENS:
                    out += flush()
                    size = 0
            return out

        return run

    schema = "n_tokens bigint, doc_ids array<bigint>, pieces array<int>, starts array<bigint>, cu_seqlens array<int>, resets array<int>, ids binary"
    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), make, schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet; `ids` are the matrix rows as a trainer maps them."""
    packed.write.parquet(path)


def matrix(rows: list, width: int = WIDTH) -> np.ndarray:
    """Id matrix of some packed rows."""
    ids = [bytes(r["ids"]) for r in rows]
    return np.frombuffer(b"".join(ids), "<u2" if len(ids[0]) == 2 * width else "<u4").reshape(-1, width)
