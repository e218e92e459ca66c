"""Token counts of greedy longest-match word pieces, in time linear in the text.

The vocabulary is a trie. A node's failure link leads to the node of what is left after taking
greedily all pieces that are certain, and its popped count says how many those are; both are
computed once when the trie is built. A word is then read symbol by symbol without ever looking
back: where a node has no child for the symbol, its popped count is added and its link
followed. The number of pieces comes out without a piece being built. New words of a block are
read in lockstep, one array operation for each symbol place; known words are remembered.

Text is NFC-normalised and lower-cased, then cut into words by PATTERN inside runs of anything
but ASCII white space. Symbols are bytes, and a word's last byte is a symbol of its own kind, as
in the vocabularies' word ends. Null and empty texts have 0 words and tokens; a symbol that is
in no piece counts as one token. Repeated rows are counted each.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import batch_of, map_arrow, texts

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # fixed value: the tokenizer's
ALPHABET = 512  # bytes, and bytes that end a word


def byte_names() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable bytes for
    themselves, the others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_pieces(path: str | None = None) -> list[tuple[int, ...]]:
    """Pieces of a byte-level vocabulary with `</w>` word ends, as symbols."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    name, out = byte_names(), []
    for token in vocabulary:
        body = token.removesuffix("</w>")
        if body and all(c in name for c in body):
            symbols = [name[c] for c in body]
            if body != token:
                symbols[-1] += 256
            out.append(tuple(symbols))
    return out


class Automaton:
    """Trie in arrays: children by sorted (node, symbol), failure links, popped counts."""

    def __init__(self, keys: np.ndarray, child: np.ndarray, fail: np.ndarray, popped: np.ndarray):
        self.keys, self.child, self.fail, self.popped = keys, child, fail, popped

    @classmethod
    def build(cls, pieces: list[tuple[int, ...]]) -> Automaton:
        child: dict[int, int] = {}
        whole = {0: False}
        order: list[tuple[int, int, int]] = []  # node, parent, symbol
        for piece in [*((s,) for s in range(ALPHABET)), *sorted(pieces, key=len)]:
            node = 0
            for symbol in piece:
                found = child.get(node * ALPHABET + symbol)
                if found is None:
                    found = child[node * ALPHABET + symbol] = len(whole)
                    whole[found] = False
                    order.append((found, node, symbol))
                node = found
            whole[node] = True
        # parents come before children, but a link may lead to any shallower node: go by depth
        depth = [0] * len(whole)
        for node, parent, _ in order:
            depth[node] = depth[parent] + 1
        fail, popped = [0] * len(whole), [0] * len(whole)
        for node, parent, symbol in sorted(order, key=lambda x: depth[x[0]]):
            if whole[node]:
                popped[node] = 1
                continue
            count, at = popped[parent], fail[parent]
            while at * ALPHABET + symbol not in child:
                count, at = count + popped[at], fail[at]
            fail[node], popped[node] = child[at * ALPHABET + symbol], count
        keys = np.array(sorted(child), np.int64)
        return cls(keys, np.array([child[k] for k in keys.tolist()], np.int32), np.array(fail, np.int32), np.array(popped, np.int32))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.keys, self.child, self.fail, self.popped

    def count(self, words: list[bytes]) -> np.ndarray:
        """Pieces of every word (not empty)."""
        lengths = np.array([len(w) for w in words])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        first = (np.cumsum([len(w) for w in words]) - [len(w) for w in words])[order]
        node, out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for place in range(int(lengths[0]) if len(words) else 0):
            active = int(np.searchsorted(-lengths, -place, side="left"))  # words longer than `place`
            symbol = data[first[:active] + place] + 256 * (lengths[:active] == place + 1)
            todo = np.arange(active)
            while len(todo):
                key = node[todo] * ALPHABET + symbol[todo]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                node[todo[hit]] = self.child[at[hit]]
                todo = todo[~hit]
                out[todo] += self.popped[node[todo]]
                node[todo] = self.fail[node[todo]]
        while node.any():
            out += self.popped[node]  # nothing is popped at the root
            node = self.fail[node].astype(np.int64)
        back = np.empty(len(words), np.int64)
        back[order] = out
        return back


class Counts(dict):
    """Chunk without ASCII white space -> (words, tokens) as one number, in bounded memory."""

    def __init__(self, automaton: Automaton, limit: int = 200_000):
        self.automaton, self.limit, self.find = automaton, limit, regex.compile(PATTERN).findall

    def learn(self, chunks: set[bytes]) -> None:
        if len(self) + len(chunks) > self.limit:
            self.clear()
        new = [c for c in chunks if c not in self]
        words, owner = [], []
        for i, chunk in enumerate(new):
            text = unicodedata.normalize("NFC", chunk.decode()).lower()
            for word in [text] if text.isalpha() else self.find(text):
                words.append(word.encode())
                owner.append(i)
        n = np.bincount(owner, minlength=len(new)) if words else np.zeros(len(new), np.int64)
        tokens = np.bincount(owner, self.automaton.count(words), len(new)).astype(np.int64) if words else n
        self.update(zip(new, ((w << 40) + t for w, t in zip(n.tolist(), tokens.tolist()))))  # Python's integers: any number of words


def count_tokens(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.build(read_pieces(vocabulary_path)).arrays())  # its size is the vocabulary's

    def make():
        known = Counts(Automaton(*shared.value))

        def run(batch):
            if batch is None:
                return []
            sums, block, size = [], [], 0
            all_texts = texts(batch)
            for i, text in enumerate(all_texts):
                block.append(text.split() if text else [])
                size += len(block[-1])
                if size > 200_000 or i == len(all_texts) - 1:
                    known.learn(set().union(*block))
                    sums += [sum(map(known.__getitem__, chunks)) for chunks in block]
                    block, size = [], 0
            n_words, n_tokens = [x >> 40 for x in sums], [x & ((1 << 40) - 1) for x in sums]
            return [batch_of(doc_id=batch.column("doc_id"), n_words=pa.array(n_words, pa.int64()), n_tokens=pa.array(n_tokens, pa.int64()))]

        return run

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), make, "doc_id bigint, n_words bigint, n_tokens bigint")
