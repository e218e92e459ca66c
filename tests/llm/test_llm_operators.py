"""The operators against plain versions, and their edges."""

import os
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from colsight.llm import (  # noqa: E402
    op1_decontaminate as op1, op2_packing as op2, op3_tokens as op3, op4_suffix as op4, op5_substring as op5, op6_jaccard as op6,
    common, op7_html as op7, op8_language as op8, op9_quality as op9, op10_binary as op10,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def vocabulary(rnd, n=400):
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats inside a text, junk, long and odd texts."""
    rnd = random.Random(7)
    names = vocabulary(rnd)

    def prose(n):
        return [rnd.choice(names) for _ in range(n)]

    passage, texts = prose(60), [None, "", " \n\t ", "one", "a b c", "A b C", "x y z", "### *** a|b"]
    base = prose(200)
    for i in range(60):
        kind = i % 6
        if kind == 0:
            w = prose(rnd.randint(1, 300))
        elif kind == 1:
            w = list(base)
            for _ in range(rnd.randint(0, 12)):
                w[rnd.randrange(len(w))] = rnd.choice(names)
        elif kind == 2:
            w = prose(rnd.randint(0, 90)) + passage + prose(rnd.randint(0, 90))
        elif kind == 3:
            w = prose(3) * 40
        elif kind == 4:
            w = prose(rnd.randint(40, 60)) + [x.upper() for x in base[: rnd.randint(20, 120)]]
        else:
            w = list(base)
        texts.append("".join(x + rnd.choice([" ", " ", " ", "\n", ", "]) for x in w))
    texts.append(" ".join(prose(30_000)))
    texts += ["same line here\n" * 30, "- point\n" * 60, "wait...\n" * 60, texts[10], texts[12]]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows + [rows[5], (None, texts[11], "en", "s", 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5).cache()


def pairs(corpus):
    return [(r[0], r[1]) for r in corpus]


def test_quality(docs, corpus):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in op9.quality(docs).collect()}
    want = set()
    for d, t in pairs(corpus):
        m = brute.measures(t)
        want.add((d, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert got == want


def test_policies_and_ablation(docs, corpus):
    rows = op9.ledger(docs).cache()
    kept = op9.apply_policy(rows, op9.POLICIES["v2"]).where("kept").count()
    failed = [r.failed for r in rows.collect()]
    assert kept == sum(not f for f in failed)
    for r in op9.ablation(rows, op9.POLICIES["v2"]).collect():
        bit = op9.BITS[r.rule]
        assert (r.rejected, r.alone) == (sum(f & bit != 0 for f in failed), sum(f == bit for f in failed)), r.rule
    assert op9.keep(docs).count() == op9.quality(docs).where("kept").count()
    assert op9.keep(docs).columns == docs.columns


@pytest.mark.parametrize("cells", [1 << 12, 1 << 26])
def test_substring(docs, corpus, cells):
    """A crowded sketch only sends more windows."""
    got = sorted(map(tuple, op5.digest(docs, cells=cells).collect()), key=repr)
    assert got == sorted(brute.kept_digests(pairs(corpus), 50, False), key=repr)


def test_substring_texts(docs, corpus):
    got = {(r.doc_id, r.text, r.n_chars) for r in op5.remove_repeats(docs).collect()}
    for (d, t), (_, _, gone, _) in zip(pairs(corpus), brute.kept(pairs(corpus), 50, False)):
        if not gone and t:
            assert (d, t, len(t)) in got
    assert len({r[0] for r in got}) < len({r[0] for r in corpus})  # exact copies are gone


def test_suffix(docs, corpus):
    got = sorted(map(tuple, op4.digest(docs).collect()), key=repr)
    assert got == sorted(brute.kept_digests(pairs(corpus), 50, True), key=repr)


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_jaccard(docs, corpus, k, num, den):
    got = sorted(map(tuple, op6.linked(docs, k, num, den).collect()), key=repr)
    assert got == sorted(brute.components(pairs(corpus), k, num, den), key=repr)


def test_jaccard_in_small_chunks(docs, corpus, monkeypatch):
    monkeypatch.setattr(op6, "CHUNK_SHINGLES", 500)
    got = sorted(map(tuple, op6.linked(docs).collect()), key=repr)
    assert got == sorted(brute.components(pairs(corpus), 4, 85, 100), key=repr)


def test_keep_one(docs, corpus):
    groups = brute.components(pairs(corpus), 5, 80, 100)
    want = sorted({d for d, n, c in groups if d is not None and d == c})
    assert sorted(r.doc_id for r in op6.keep_one(docs).collect() if r.doc_id is not None) == want


def test_rows_without_id_take_no_keys(spark):
    """The null row comes first in the only partition; its text has a near copy under real doc_ids."""
    words = vocabulary(random.Random(11), 200)
    near = [*words[:-1], "changed"]
    rows = [(None, " ".join(words), "en", "s", 1), (2, " ".join(words), "en", "s", 1), (1, " ".join(near), "en", "s", 1)]
    table = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = sorted(map(tuple, op6.linked(table).collect()), key=repr)
    assert got == sorted(brute.components(pairs(rows), 4, 85, 100), key=repr)
    assert sorted(r.doc_id for r in op6.keep_one(table).collect() if r.doc_id is not None) == [1]


def test_large_blocks_and_stars_are_dealt(spark, monkeypatch):
    """Families of near copies and a passage in unlike texts: no task's group or part grows with them."""
    rnd = random.Random(12)
    names = vocabulary(rnd)
    base, passage = [rnd.choice(names) for _ in range(120)], [rnd.choice(names) for _ in range(60)]
    texts = [[*base[:i], "changed", *base[i + 1 :]] for i in range(0, 120, 3)] + [passage + [rnd.choice(names) for _ in range(60)] for _ in range(40)]
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    want = sorted(brute.components(pairs(rows), 4, 85, 100), key=repr)
    monkeypatch.setattr(op6, "BLOCK_SETS", 8)
    sizes, forests = [], op6._forests

    def watched(groups, num, den):
        sizes.append(groups.groupBy("key", "x", "y").count().agg({"count": "max"}).first()[0])
        return forests(groups, num, den)

    monkeypatch.setattr(op6, "_forests", watched)
    assert sorted(map(tuple, op6.linked(spark.createDataFrame(rows, DOCS)).collect()), key=repr) == want
    assert len(sizes) == 2 and max(x or 0 for x in sizes) <= 4 * 8  # parts by hash: 8 on average, pairs 16
    monkeypatch.setattr(op6, "LINKS", 100)
    star = op6.fewer_links(spark.range(1, 1001).selectExpr("0L AS a", "id AS b"))
    held = [r["count"] for r in star.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 1000 and max(held) < 300


def test_two_texts_of_one_id_are_judged_apart(spark):
    names = vocabulary(random.Random(14))
    copied, clean = " ".join(names[:80]), " ".join(names[100:180])
    table = spark.createDataFrame([(1, copied, "en", "s", 1), (5, copied, "en", "s", 1), (5, clean, "en", "s", 1)], DOCS)
    assert sorted((r.doc_id, r.text) for r in op6.keep_one(table).collect()) == [(1, copied), (5, clean)]
    items = spark.createDataFrame([(1, " ".join(names[20:40]))], "item_id bigint, text string")
    assert [(r.doc_id, r.text) for r in op1.decontaminate(table, items).collect()] == [(5, clean)]


def test_families_larger_than_a_chunk(spark, monkeypatch):
    """Chains that no single copy links, a star, and a candidate group that isn't one group."""
    rnd = random.Random(15)
    names = vocabulary(rnd, 3000)
    base = [rnd.choice(names) for _ in range(200)]
    chain = [[f"new{j}" if j < 4 * i else w for j, w in enumerate(base)] for i in range(30)]
    star = [[*base[100:150], *base[:50], *[f"s{i}"] * (i % 3)] for i in range(40)]
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate([*chain, *star, *chain[:5]])]
    rnd.shuffle(rows)
    for chunk in (150, 1000):
        monkeypatch.setattr(op6, "CHUNK_SHINGLES", chunk)
        got = sorted(map(tuple, op6.linked(spark.createDataFrame(rows, DOCS)).collect()))
        assert got == sorted(brute.components(pairs(rows), 4, 85, 100))


@pytest.mark.parametrize("num,den", [(80, 100), (85, 100), (50, 100)])
def test_linked_sets_share_a_block(num, den):
    """Pairs at the threshold, of equal size and as unequal as they can be, meet in one band at least."""
    rnd = np.random.default_rng(5)
    bands = op6.Bands(num, den)
    for n in [*range(2, 60), 100, 301, 640, 2000]:
        for more in {0, n * (den - num) // num // 2, n * (den - num) // num}:  # shingles that only the larger one has
            both = -(-num * (2 * n + more) // (num + den))  # fewest that are enough
            if both > n:
                continue
            s = rnd.integers(0, 1 << 63, 2 * n + more - both).astype(np.uint64) * np.uint64(2)
            a, b = np.unique(s[:n]), np.unique(s[n - both :])
            assert len(b) == n + more and den * both >= num * (2 * n + more - both)
            keys = [op6.block_keys(x, bands) for x in (a, b)]
            equal = len(np.intersect1d(a, b)) == len(a) == len(b)
            assert equal or len(np.intersect1d(*keys)), (n, more)


def test_blocks_are_few_and_never_stored(spark, docs, monkeypatch):
    """About half a key a shingle, of 48 bits; they go from where they are computed to where they meet."""
    bands, rnd = op6.Bands(80, 100), np.random.default_rng(6)
    sets = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in range(100, 1500, 10)]
    keys = [op6.block_keys(s, bands) for s in sets]
    assert sum(map(len, keys)) < 0.54 * sum(map(len, sets)) and max(k.max() for k in keys) < 1 << 48
    staged, stage = [], op6.stage

    def watched(df):
        staged.append((df.columns, dict(df.dtypes)))
        return stage(df)

    monkeypatch.setattr(op6, "stage", watched)
    op6.linked(docs, 5, 80, 100).collect()
    assert staged and not any("keys" in names for names, _ in staged)
    assert not any(t == "array<bigint>" for names, types in staged for c, t in types.items() if c != "near")


def test_exact_links_with_known_groups():
    """One family: every set is linked once, and sets of a known group aren't linked again."""
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 1 << 62, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rnd.permutation(300)[:285]], rnd.integers(0, 1 << 62, 15).astype(np.uint64)])) for _ in range(3000)]
    assert len(op6.exact_links(np.arange(3000), sets, 80, 100)) == 2999
    links = op6.exact_links(np.arange(3000), sets, 80, 100, np.arange(3000) % 2)
    assert len(links) == 1 and (links[0][0] + links[0][1]) % 2 == 1


def test_exact_links_by_brute_force():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 62, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, 60, replace=False), rnd.integers(0, 1 << 62, rnd.integers(0, 20)).astype(np.uint64)])) for _ in range(60)]
    root = {i: i for i in range(60)}

    def find(r, x):
        while r[x] != x:
            x = r[x]
        return x

    for a in range(60):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 10 * both >= 6 * (len(sets[a]) + len(sets[b]) - both):
                root[find(root, a)] = find(root, b)
    mine = {i: i for i in range(60)}
    for a, b in op6.exact_links(np.arange(60), sets, 6, 10):
        mine[find(mine, a)] = find(mine, b)
    assert {frozenset(j for j in root if find(root, j) == find(root, i)) for i in root} == {frozenset(j for j in mine if find(mine, j) == find(mine, i)) for i in mine}


def test_search(spark, docs, corpus):
    long = next(t for _, t in pairs(corpus) if t and len(t) > 100_000).split()
    items = [(1, " ".join(long[5000:5012])), (2, " ".join(long[9000:9060]).encode().upper().decode()), (3, "a b c"), (4, None), (5, " ".join([*long[100:140], "changed", *long[141:160]])), (6, "not in any text at all here"), (7, " ".join(long[:300])), (8, " ".join(long[5000:5012]))]
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in op1.search(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == brute.contained(pairs(corpus), items) and {i for _, i, _, _ in got} >= {1, 2, 5, 7, 8}


def test_search_misses_no_short_or_repetitive_item(spark):
    rnd = random.Random(13)
    names = vocabulary(rnd, 3000)
    items = [(1, " ".join(names[:5])), (2, " ".join(names[5:8] * 120))]
    rows = [(i, " ".join([*rnd.choices(names, k=8), items[0][1], *rnd.choices(names, k=8), *([items[1][1], *rnd.choices(names, k=700)] if i < 60 else [])])) for i in range(4000)]
    found = op1.search(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert sorted(got) == sorted([(i, 1) for i in range(4000)] + [(i, 2) for i in range(60)])


def test_short_items_are_runs_of_their_words(spark):
    rows = [(1, "Only\tFour words Here"), (2, "only four words"), (3, "it says only four words here and goes on"), (4, "four"), (5, None), (6, ""), (7, "two two two two")]
    items = [(1, "only four words here"), (2, "FOUR"), (3, "words here"), (4, "two two"), (5, ""), (6, None), (7, "it says only four words here"), (8, "here words")]
    found = op1.search(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found.collect()}
    assert got == brute.contained(rows, items) and {(1, 1), (3, 1), (4, 2), (7, 4), (3, 7)} <= {x[:2] for x in got}


def test_a_shared_phrase_makes_no_candidates(spark):
    """Every item and every document has the same 15 words; only the copied items are contained."""
    rnd = random.Random(31)
    names = vocabulary(rnd, 3000)
    phrase = names[:15]
    items = [(i, " ".join([*rnd.choices(names, k=6), *phrase, *rnd.choices(names, k=6)])) for i in range(200)]
    rows = [(i, " ".join([*rnd.choices(names, k=30), *(items[i][1].split() if i < 20 else phrase), *rnd.choices(names, k=30)])) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    shingles = op1.item_shingles(tests).cache()
    hits = op1.document_hits(docs, shingles).cache()
    assert op1.candidates(hits, op1.signatures(shingles, hits)).count() < 100  # of 200,000
    assert {(r.doc_id, r.item_id) for r in op1.search(docs, tests).collect()} == {(i, i) for i in range(20)}
    assert brute.contained(rows[:40], items) == {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in op1.search(docs.where("doc_id < 40"), tests).collect()}


def test_contaminated_rows_without_id_go(spark):
    table = spark.createDataFrame([(None, "one two three four five six", "en", "s", 1), (None, "none of that is in here", "en", "s", 1)], DOCS)
    items = spark.createDataFrame([(1, "two three four five six")], "item_id bigint, text string")
    assert [r.text for r in op1.decontaminate(table, items).collect()] == ["none of that is in here"]


def test_items_without_id_are_obeyed(spark):
    rows = [(1, "one two three four five six", "en", "s", 1), (2, "none of that is in here", "en", "s", 1)]
    items = spark.createDataFrame([(None, "two three four five six")], "item_id bigint, text string")
    table = spark.createDataFrame(rows, DOCS)
    assert [r.doc_id for r in op1.decontaminate(table, items).collect()] == [2]
    assert op1.search(table, items).count() == 0


def test_search_keeps_the_rest(spark, docs):
    items = spark.createDataFrame([(1, "nothing of this kind is in there")], "item_id bigint, text string")
    assert op1.decontaminate(docs, items).count() == docs.count()


def bound(sizes, capacity):
    return op2.lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)


def tokenizer():
    import public_tokenizers as p
    from tokenizers import Tokenizer

    return Tokenizer.from_file(p.path("word_bpe_49k.json"))


def test_packing(docs, corpus):
    t, want = tokenizer(), []
    for d, text in pairs(corpus):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for i, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((d, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = op2.pack_documents(docs).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == bound(np.array([w[3] for w in want]), 2048)


def test_packing_exchanges_between_groups(spark):
    rnd = random.Random(1)
    items = spark.createDataFrame([(i, rnd.randint(1, 100)) for i in range(3000)], "doc_id bigint, length bigint")
    rows = op2.pack(items, capacity=100, group_pieces=500).collect()
    sums = defaultdict(int)
    for r in rows:
        sums[r.sequence_id] += r.length
    least = bound(np.array([r.length for r in rows]), 100)
    assert len(rows) == 3000 and max(sums.values()) <= 100 and len(sums) <= 1.015 * least


def test_lower_bound_holds():
    rnd = np.random.default_rng(0)
    assert bound(np.full(10, 51), 100) == 10  # no two fit together: more than the sum says
    assert bound(np.array([60, 60, 40, 40]), 100) == 2
    for _ in range(200):
        sizes = rnd.integers(1, 101, rnd.integers(1, 40))
        assert bound(sizes, 100) <= op2.best_fit_decreasing(sizes, 100)[2]


def test_chunks_encode_as_whole_texts():
    rnd, t, known = random.Random(2), tokenizer(), op2.ChunkIds(op2.tokenizer_json())
    letters = "abAB'sStTéÉİıßẞſŉǅΣσς#<|>09½ \t\ń日 \x1c"
    odd = ["It's we'LL <|endoftext|> a<|startoftext|>b", "é ́x", "日本語 ﬁ ½"]
    for text in odd + ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(300)]:
        assert np.frombuffer(known.of(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_token_counts(docs, corpus):
    pieces = set(op3.read_pieces())
    regex, unicodedata = pytest.importorskip("regex"), __import__("unicodedata")

    def greedy(word):
        s = [*word[:-1], word[-1] + 256]
        n = at = 0
        while at < len(s):
            end = len(s)
            while end > at + 1 and tuple(s[at:end]) not in pieces:
                end -= 1
            at, n = end, n + 1
        return n

    got = sorted([(r.doc_id, r.n_words, r.n_tokens) for r in op3.count_tokens(docs).collect() if r.n_words < 5000], key=repr)
    want = []
    for d, t in pairs(corpus):
        found = [w.encode() for c in brute.words(t) for w in regex.findall(op3.PATTERN, unicodedata.normalize("NFC", c.decode()).lower())]
        if len(found) < 5000:
            want.append((d, len(found), sum(map(greedy, found))))
    assert got == sorted(want, key=repr)


def test_token_counts_of_very_long_texts(spark):
    n = (1 << 23) + 5
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), n).alias("text"))
    assert [tuple(r) for r in op3.count_tokens(docs).collect()] == [(0, n, n)]


def test_automaton_follows_links():
    a = op3.Automaton.build([tuple(b"abcd"), tuple(b"bc"), tuple(b"bcdx"), (*b"ab", 256 + ord("c"))])
    words = [b"abc", b"abcx", b"abcdbc", b"bcdy", b"a"]  # abc. / a,bc,x. wouldn't be greedy: a b..., see below
    pieces = {tuple(b"abcd"), tuple(b"bc"), tuple(b"bcdx"), (*b"ab", 256 + ord("c"))}

    def greedy(word):
        s, n = [*word[:-1], word[-1] + 256], 0
        while s:
            take = next((k for k in range(len(s), 1, -1) if tuple(s[:k]) in pieces), 1)
            s, n = s[take:], n + 1
        return n

    assert a.count(words).tolist() == [greedy(w) for w in words]


def test_binary_round_trip(docs, corpus):
    rows, t = op10.packed_rows(docs).collect(), tokenizer()
    m, back = op10.matrix(rows), defaultdict(list)
    for k, r in enumerate(rows):
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 2048 and r.resets == r.cu_seqlens[:-1]
        for d, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            back[d].append((start, m[k, a:b].tolist()))
    want = defaultdict(list)
    for d, text in pairs(corpus):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want[d] += [(at, ids[at : at + 2048]) for at in range(0, len(ids), 2048)]
    assert {d: sorted(v) for d, v in back.items()} == {d: sorted(v) for d, v in want.items()}


def test_segment_tree_finds_the_best_fit():
    rnd = random.Random(5)
    tree, rooms = op10.CapacityTree(100), []
    for b in range(500):
        if rnd.random() < 0.5:
            rooms.append(rnd.randint(1, 99))
            tree.put(rooms[-1], b)
        else:
            need = rnd.randint(1, 100)
            fits = [r for r in rooms if r >= need]
            found = tree.take(need)
            assert (found[0] if found else None) == (min(fits) if fits else None)
            if found:
                rooms.remove(found[0])


PAGES = {
    "plain": ("<html><body><nav><a href=/>Home</a></nav><article><h1>Title &amp; more</h1><p>One  two<br>three.<p>Sh&eacute; left.</article><footer>&copy; me</footer></body></html>", "Title & more\nOne two three.\nShé left."),
    "ads and comments inside": ("<main><p>First words of it.</p><div class='ad-box'>Buy now, it is cheap and good for you.</div><p>Last words.</p><section id=comments><article class=comment><p>I like this very much, thank you for it.</p></article></section></main>", "First words of it.\nLast words."),
    "no article": ("<div id=menu><a href=a>One</a> <a href=b>Two</a></div><div><p>A long enough paragraph that says a number of things in a row, as prose does.</p><p>Another one follows it, and it is just as long as the one before it was.</p></div><div class=sidebar>Popular posts of the week and other such things to read.</div>", "A long enough paragraph that says a number of things in a row, as prose does.\nAnother one follows it, and it is just as long as the one before it was."),
    "silent elements": ("<article><p>Say</p><script>var a='</p>not';</script><style>p{}</style><form><p>Your name and address here</p><input></form><noscript>Turn it on</noscript><p hidden>secret</p><!-- not <p>this</p> --><p>it.</p></article>", "Say\nit."),
    "notices": ("<div class='cookieNotice'>We use cookies to make this page better for everyone.</div><article><header><h1>Head</h1></header><p>Text <b>bold</b><i>er</i> and <a href=x>a link</a>.</p><aside>By the way, there is more.</aside></article>", "Head\nText bolder and a link."),
    "lists and tables": ("<article><ul><li>first<li>second</ul><table><tr><td>a<td>b<tr><td>c</table><blockquote>said</blockquote></article>", "first\nsecond\na\nb\nc\nsaid"),
    "broken": ("<article><p>Open <b>bold <p>next</article", "Open bold\nnext"),
    "words only": ("just text & nothing else, but quite a few words of it in one line.", "just text & nothing else, but quite a few words of it in one line."),
    "form around all": ("<form><article><p>Inside of a form.</p></article></form>", "Inside of a form."),
    "empty": ("", ""),
    "null": (None, ""),
}


def test_pages(spark):
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES.values())]
    got = {r.page_id: r for r in op7.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()}
    for i, (name, (_, want)) in enumerate(PAGES.items()):
        assert got[i].text == want, name
        assert got[i].n_chars == len(want)


def test_long_page():
    page = "<body><nav>" + "<a href=x>go</a>" * 2000 + "</nav><article>" + "".join(f"<p>Paragraph number {i}.</p>" for i in range(3000)) + "</article>"
    assert op7.main_text(page) == "\n".join(f"Paragraph number {i}." for i in range(3000))


def test_minimum_cut_by_brute_force():
    from itertools import product

    rnd = random.Random(4)
    for _ in range(60):
        n = rnd.randint(1, 7)
        arcs = [(n, i, rnd.randint(0, 9), 0) for i in range(n)] + [(i, n + 1, rnd.randint(0, 9), 0) for i in range(n)]
        arcs += [(i, j, w, w) for i in range(n) for j in range(i) for w in [rnd.randint(0, 4)]]
        net = op7.Network(n + 2)
        for a in arcs:
            net.add(a[0], a[1], float(a[2]), float(a[3]))
        level = net.push_all(n, n + 1)

        def cut(side):
            return sum(w for a, b, w, _ in arcs if side[a] and not side[b]) + sum(w for a, b, _, w in arcs if side[b] and not side[a])

        best = min(cut([*s, True, False]) for s in product([True, False], repeat=n))
        assert cut([lv >= 0 for lv in level[:n]] + [True, False]) == pytest.approx(best)


def test_languages(spark):
    rnd, rows = random.Random(9), []
    names = {lang: vocabulary(random.Random(i), 150) for i, lang in enumerate(("aa", "bb", "cc"))}
    for i in range(600):
        lang = rnd.choice(list(names))
        rows.append((i, " ".join(rnd.choice(names[lang]) for _ in range(40)), lang))
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "12 --- 3", "bb"), (None, " ".join(names["bb"][:30]), "bb"), rows[0], (1003, rows[1][1], None)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id bigint, text string, lang string, score string")
    got = op8.identify(docs).collect()
    truth = {r[0]: r[2] for r in rows[:600]}
    out = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 80 and sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1000, 1001, 1002)) and out[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)


def test_many_languages_use_more_masks():
    cells = np.zeros((1 << op8.CELL_BITS, 13), np.uint8)
    gram = np.array([0x0123456789ABCDEF], np.uint64)
    for i in range(op8.HASHES):
        cells[(int(gram[0]) >> (op8.CELL_BITS * i)) & ((1 << op8.CELL_BITS) - 1), 70 // op8.MASK_BITS] |= np.uint8(1 << (70 % op8.MASK_BITS))
    votes = op8.Filter([f"l{i}" for i in range(100)], cells).votes(gram, np.array([0]), 2)
    assert votes.tolist() == [[1.0, *(float(i == 70) for i in range(100))], [0.0] * 101]


def test_grams_by_brute_force():
    letters = np.unpackbits(op8.letter_table()).astype(bool)
    some = ["Ab c", None, "", "12", "aß-Ñ日本", " x "]
    counts, grams = op8.read_grams(some, letters)
    assert counts.tolist() == [sum(c.isalpha() for c in (t or "").lower()) for t in some]
    for n, (h, owner) in zip(op8.LENGTHS, grams):
        want = []
        for i, t in enumerate(some):
            for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
                want += [(i, f" {w} "[j : j + n]) for j in range(len(w) + 3 - n)]
        assert sorted(owner.tolist()) == [i for i, _ in sorted(want)]
        assert len(set(h.tolist())) == len({g for _, g in want})


def test_pipeline(spark, corpus, tmp_path):
    """Every stage by plain code, each on what its predecessor kept; then run() as a whole."""
    import corpus_pipeline

    long = next(t for _, t in pairs(corpus) if t and len(t) > 100_000).split()
    short = next(t for _, t in pairs(corpus) if t and 150 < len(t.split()) < 250).split()
    items = [(1, " ".join(long[700:730])), (2, " ".join(short[20:45])), (3, "a b"), (4, None)]
    spark.createDataFrame(corpus, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = []
    for d, t in pairs(corpus):
        n, _, symbols, dup, again = brute.measures(t)
        lines = [x for x in (t or "").split("\n") if x.split()]
        if n >= 50 and 2 * again <= n and 10 * symbols <= n and 2 * dup <= len(lines):
            docs.append((d, t))
    want = [docs]
    groups = brute.components(docs, 5, 80, 100)
    docs = list(dict.fromkeys(x for x, (d, _, c) in zip(docs, groups) if d is None or d == c))
    want.append(docs)
    docs = [(d, left.decode() if gone else t) for (d, t), (_, _, gone, left) in zip(docs, brute.kept(docs, 50, False)) if left or not gone]
    want.append(docs)
    bad = {x for x in docs if brute.contained([(0, x[1])], items)}  # also rows without doc_id
    docs = [x for x in docs if x not in bad]
    want.append(docs)
    assert len({len(w) for w in want}) >= 3 and bad  # the stages do something here

    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (name, function) in enumerate(corpus_pipeline.STAGES[:4]):
        function(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/stage{i}")
        kept = spark.read.parquet(f"{tmp_path}/stage{i}")
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(want[i], key=repr), name
    t, pieces = tokenizer(), []
    for d, text in docs:
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        pieces += [(d, i, at, zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for i, at in enumerate(range(0, len(ids), 2048))]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.ids_crc32) for r in rows], key=repr) == sorted(pieces, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id bigint, text string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    results = [
        op1.search(none, items), op1.decontaminate(none, items), op2.pack_documents(none), op3.count_tokens(none), op4.digest(none), op5.digest(none),
        op5.remove_repeats(none), op6.linked(none), op6.keep_one(none), op7.extract(pages), op8.identify(none), op9.quality(none), op10.packed_rows(none),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_clashing_columns(spark, corpus):
    """Columns named as the operators' own are carried or left alone."""
    internal = ["m_n_words", "__doc", "__text", "__place", "__starts", "__key", "__found", "Text", "column_1"]
    names = [*internal, "key", "cls", "place", "starts", "one", "two", "n", "grp", "row_id", "n_words", "failed", "kept", "found", "item_id"]
    rows = [(*r, *(["x"] * len(names))) for r in corpus[:30]]
    wide = spark.createDataFrame(rows, DOCS + ", " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, "a b c d e f", "x")], "item_id bigint, text string, key string")
    for out in (op9.keep(wide), op6.keep_one(wide), op5.remove_repeats(wide), op4.remove_repeats(wide), op1.decontaminate(wide, items)):
        assert out.columns == wide.columns and out.count() > 0
        assert out.select("__starts", "m_n_words").distinct().collect() == [("x", "x")]
    wide = wide.toDF(*("other" if c == "Text" else c for c in wide.columns))
    for out in (op2.pack_documents(wide), op3.count_tokens(wide), op4.digest(wide), op6.linked(wide), op8.identify(wide), op10.packed_rows(wide)):
        assert out.count() > 0


def test_rows_set_apart(spark):
    """No named row is kept apart, most others are; nulls in both columns, a bitmap of one row and a full one."""
    rows = [(i if i % 50 else None, f"text {i % 700}" if i % 70 else None) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    named = docs.where("coalesce(doc_id, 0) % 10 = 0").select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"))
    want = {r for r in rows if (r[0] or 0) % 10 == 0}
    for bits, low in ((1 << 24, 1700), (1 << 15, 1600), (1 << 4, 0)):
        single, rest = common.set_apart(docs, named, bits)
        a, b = [tuple(r) for r in single.collect()], [tuple(r) for r in rest.collect()]
        assert sorted(a + b, key=repr) == sorted(rows, key=repr) and want <= set(b) and not want & set(a) and len(a) >= low
    single, rest = common.set_apart(docs, named.limit(0))
    assert single.count() == 2000 and rest.count() == 0
