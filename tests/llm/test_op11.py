"""Alignment of two tokenizers against plain code that encodes whole texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from colsight.llm import op11_alignment as op11
from colsight.llm.op3_tokens import byte_names

ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  two  spaces  ", "tab\tand\nlines\r\n \n x", "it's we're I'LL don't",
    "<|endoftext|> <s> </s> <0x41> <unk>", "U+2581 ▁ here", "nb sp   x 　 y", "é ́ x", "日本語 テキスト 😀👍🏽",
    "\x00 nul \x1c \x85 z", "a" * 300, "1234567 89 0", "…—“q”", "▁▁", " ̈x", "x\n y", "x \ny", "\n", "ﬁ ﬂ ½ Ⅷ",
]


@pytest.fixture(scope="module")
def plain():
    """Whole texts, encoded by the libraries themselves and linked by comparing all byte ranges of a neighbourhood."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    name = byte_names()

    def ranges(ids, to_bytes):
        out, at = [], 0
        for i in ids:
            x = to_bytes(i)
            out.append((at, at + len(x), i, x))
            at += len(x)
        return out

    def bytes_b(i):
        p = b.id_to_piece(i)
        m = re.fullmatch("<0x(..)>", p)
        return bytes.fromhex(m[1]) if m else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], [], [], []
        whole = (" " + text).encode()
        ra = ranges(a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(name[c] for c in a.id_to_token(i)))
        rb = ranges(b.encode(text), bytes_b)
        if b"".join(x[3] for x in ra) != whole or b"".join(x[3] for x in rb) != whole:
            return [], [], [], []
        met, j0 = [], 0
        for s, e, i, _ in ra:
            while rb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(rb) and rb[j][0] < e:
                met.append((i, rb[j][2]))
                j += 1
        both = {x[1] for x in ra} & {x[1] for x in rb}

        def grouped(tokens):
            out = [[]]
            for _, end, i, _ in tokens:
                out[-1].append(str(i))
                if end in both:
                    out.append([])
            return [",".join(x) for x in out[:-1]]

        groups = [f"{x}|{y}" for x, y in zip(grouped(ra), grouped(rb))]
        return ra, rb, groups, met

    def run(rows):
        memo = {t: one(t) for t in {t for _, t in rows}}
        count = Counter(p for _, t in rows for p in set(memo[t][3]))
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for d, t in rows:
            ra, rb, groups, met = memo[t]
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ra else ""
            out.append((d, len(ra), len(rb), len(groups), len(met), sum(count[p] == best[p[0]] for p in met), sum(count[p] for p in met), digest))
        return sorted(out, key=repr)

    return run


def some_rows(n=120):
    rnd = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzéüß"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    texts = list(ODD)
    for _ in range(n):
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\n", ", ", " ", " 12", "'s "]) for _ in range(rnd.randint(1, 80))))
    texts += [texts[30]] * 40 + [texts[31]] * 3
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return rows + [rows[3], (None, texts[32]), (None, None)]


def test_against_plain_code(spark, rows, plain):
    data = some_rows()
    got = rows(op11.align(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)))
    assert got == plain(data)


def test_pairs_joined_by_shuffle(spark, rows, plain):
    data = some_rows(30)
    assert rows(op11.align(spark.createDataFrame(data, "doc_id bigint, text string"), pair_limit=0)) == plain(data)


def test_segments_and_memory_change_nothing(spark, rows, plain, monkeypatch):
    rnd = random.Random(2)
    long = "".join(rnd.choice(["ab", "x  ", "über ", "\n ", "word ", "  ", "q"]) for _ in range(3000))
    data = [(1, long), (2, long + "▁" + long), (3, "y" * 5000), (4, "abc " * 500)]
    models = op11.read_models()
    for segment, limit in ((1 << 20, 100_000), (50, 5)):
        monkeypatch.setattr(op11, "SEGMENT", segment)
        monkeypatch.setattr(op11, "REMEMBERED", limit)
        chunks = [c for s in op11.segments(long, True) for c in s]
        assert "".join(chunks) == " " + long
        pair = op11.Pair(*models)
        assert pair.cuts
        whole = pair.encode([" " + long])
        parts = pair.encode(chunks)
        assert [[i for x in p for i in x] for p in parts] == [w[0] for w in whole]
        assert rows(op11.align(spark.createDataFrame(data, "doc_id bigint, text string"))) == plain(data)


def test_whole_texts_without_cuts(spark, rows, plain, monkeypatch):
    data = some_rows(10)
    real = op11.segments
    monkeypatch.setattr(op11, "segments", lambda text, cuts: real(text, False))
    assert rows(op11.align(spark.createDataFrame(data, "doc_id bigint, text string"))) == plain(data)


def test_sorted_ends_are_merged():
    rnd = random.Random(3)
    for n, m in ((0, 0), (0, 5), (7, 0), (400, 300)):
        x, y = (np.array(sorted(rnd.choices(range(1, 500), k=k)), np.int64) for k in (n, m))
        out = op11.merged(x, y)
        assert out.dtype == np.int64 and out.tolist() == sorted({*x.tolist(), *y.tolist()})


def test_room_doubles():
    """What is held isn't copied for every block."""
    held, rooms = op11.put(np.empty((2, 0), np.int64), 0, np.zeros((2, 3), np.int64)), set()
    for at in range(3, 1000):
        held = op11.put(held, at, np.full((2, 1), at))
        rooms.add(held.shape[-1])
    assert held[1, 3:1000].tolist() == list(range(3, 1000)) and len(rooms) < 12


def test_empty_and_clashing_columns(spark, rows):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows(op11.align(empty)) == []
    names = ["digest", "copies", "pairs", "times", "pair", "n_docs", "is_best", "best", "a", "n_a", "n_best", "groups_sha256"]
    one = spark.createDataFrame([(7, "hello world", *["z"] * len(names))], "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    assert rows(op11.align(one)) == rows(op11.align(one.select("doc_id", "text")))
    assert rows(op11.align(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_whole_table(spark, rows, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows(op11.align(docs)) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
