"""Exact n-gram Jaccard self-join by parity sketches, and the groups of linked documents.

Two sets of a and b shingles with Jaccard similarity t or more differ in at most
(a + b)(1 - t)/(1 + t) shingles. Sizes fall into bands, and a pair meets in the band of its
smaller set: a set goes to its own band and, if a partner can be that small, to the one below.
For each band every shingle is hashed to one of m blocks
and the block keeps the XOR of its shingles (its parity sketch): a differing shingle spoils at
most one block, so with m = d + 1 + e blocks at least e + 1 agree, and one that isn't empty
does if a set has at most e empty blocks (sets with more also send the empty ones).

1. Each distinct set sends its blocks, which are shuffled from where they are computed and never
   stored; blocks seen in two sets meet. Blocks with the same sets count once.
2. Inside a block a bit sketch (one parity bit a hash position) bounds the difference from below
   by its Hamming distance. The sets that pass are joined by a spanning forest, never all pairs.
   A block of more than BLOCK_SETS sets is dealt into parts of about that many, each block in its
   own way. What the parts leave unconnected meets in pairs of parts: near copies share many
   blocks and are connected by then, so it is few unless a block's sets aren't near each other.
3. The forests' components hold every linked pair. They are verified exactly on the full sets, rarest
   shingles first, and again only spanning links leave the task. Large ones are dealt into chunks of
   bounded size, by one min-hash and again by another, which connects near copies; then sets that
   are still unconnected meet in pairs of chunks, so each pair is compared or connected.

Equal sets are one class from the start, whatever their number. Nothing is capped.

Words are ASCII-lower-cased runs of anything but ASCII white space. Documents without words
(null, empty) have no shingles and link with nothing. Rows without doc_id get component null and
link nothing. Repeated rows are equal sets and so are linked.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import NUMBER_ROWS, WordHashes, batch_of, bitmap, has_bit, lower_words, map_arrow, mix, names_apart, runs, set_apart, shingles, signed, sized, stage, text_hash, texts
from colsight.operators.components import components
from colsight.plans.staging import drop

CHUNK_SHINGLES = 3_000_000  # shingles of a chunk: memory of a task, not a limit on groups
DOC_BITS = 1 << 25
BLOCK_SETS = 1000  # sets of a part of a block: memory of a task, not a limit on blocks
LINKS = 400_000  # links a task holds at once
TRIED = 8  # posting lists of a group, and sets of each, that are compared before the rest
SALTS = (np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C))  # fixed values: one min-hash each


class Bands:
    """Size bands: band i holds sizes high[i - 1] + 1 to high[i], high[i] = high[i - 1] / t. Wider ones would take fewer
    keys, but their small sets more blocks than they need, of so few shingles that unlike sets meet."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.high = [1]

    def of(self, size: int) -> int:
        while self.high[-1] < size:
            self.high.append(max(self.high[-1] + 1, self.high[-1] * self.den // self.num))
        return bisect_left(self.high, size)

    def met(self, size: int) -> list[int]:
        """Bands of the sets that are no larger than one of `size` and can link with it."""
        own = self.of(size)
        below = own
        while below and self.high[below - 1] * self.den >= size * self.num:
            below -= 1
        return list(range(below, own + 1))

    def differing(self, sizes: int) -> int:
        """Most differing shingles of linked sets with `sizes` shingles together."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def blocks(self, band: int) -> tuple[int, int]:
        """(blocks, empty blocks that need not be sent) for pairs whose smaller set is in `band`."""
        d = self.differing(self.high[band] + self.high[band] * self.den // self.num)
        if not d:
            return 0, 0  # sets this small link only if equal
        spare = 2 + d // 64
        return d + 1 + spare, spare


def block_keys(s: np.ndarray, bands: Bands) -> np.ndarray:
    """One key for each block of a set, for every band that it meets. Keys have 48 bits, which compress better than
    64: blocks that meet by chance cost a comparison of sketches and change no result."""
    out = []
    for band in bands.met(len(s)):
        m, spare = bands.blocks(band)
        if not m:
            continue
        at = ((s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        parity = np.zeros(m, np.uint64)
        np.bitwise_xor.at(parity, at, s)
        name = np.arange(m, dtype=np.uint64) + (np.uint64(band) << np.uint64(32))
        sent = parity != 0
        if m - sent.sum() > spare:
            sent[:] = True
        out.append(mix(parity[sent] ^ mix(name[sent])) >> np.uint64(16))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def parity_bits(s: np.ndarray) -> bytes:
    """Parity of the shingles at each of 2^j >= size hash positions, 64 at least."""
    n = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8), bitorder="little").tobytes()


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


class Met(set):
    """Sets that a task has met; forgets all when full, so memory stays bounded."""

    def first(self, cls: int) -> bool:
        if cls in self:
            return False
        if len(self) >= 300_000:
            self.clear()
        self.add(cls)
        return True


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, bits): `cls` names the set; a task gives bits of a set only the
    first time it meets it under a doc_id."""

    def make():
        memo, met = WordHashes(), Met()

        def run(batch):
            if batch is None:
                return []
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                s = shingles(memo.of(lower_words(text)), k)
                cls = set_key(s) if len(s) else None
                rows.append((len(s), cls, parity_bits(s) if len(s) and doc is not None and met.first(cls) else None))
            n, cls, bits = zip(*rows)
            return [batch_of(doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"), n_shingles=pa.array(n, pa.int64()), cls=pa.array(cls, pa.int64()), bits=pa.array(bits, pa.binary()))]

        return run

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), text_hash().alias("text_hash")), make, "doc_id bigint, text_hash bigint, n_shingles bigint, cls bigint, bits binary")


def document_blocks(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(key, cls): the blocks of the sets of rows with doc_id; a task gives those of a set the first time it meets it."""

    def make():
        memo, bands, met = WordHashes(), Bands(num, den), Met()

        def run(batch):
            if batch is None:
                return []
            names, keys = [], []
            for text in texts(batch):
                s = shingles(memo.of(lower_words(text)), k)
                if len(s) and met.first(cls := set_key(s)):
                    names.append(cls)
                    keys.append(block_keys(s, bands))
            if not names:
                return []
            return [batch_of(key=signed(np.concatenate(keys)), cls=pa.array(np.repeat(np.array(names, np.int64), [len(x) for x in keys])))]

        return run

    return map_arrow(docs.where(F.col("doc_id").isNotNull()).select(F.col("text").cast("string")), make, "key bigint, cls bigint")


def _meeting(rows: DataFrame) -> DataFrame:
    """(key, cls, size) of blocks that two or more sets have. The key is a hash of the block's sets:
    similar sets agree in many blocks, and blocks with the same sets are one from here on."""

    def task(batches):
        for table in runs(sized(batches, NUMBER_ROWS), ["key"]):
            key, cls = table.column("key").to_numpy(), table.column("cls").to_numpy()
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
            key, cls = key[fresh], cls[fresh]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(at, len(key)))
            block = np.add.reduceat(mix(cls.view(np.uint64)), at) + size.astype(np.uint64)
            met = np.repeat(size > 1, size)
            if met.any():
                rows = np.unique(np.stack([np.repeat(mix(block), size)[met], cls[met].view(np.uint64), np.repeat(size, size)[met].astype(np.uint64)]), axis=1)
                yield batch_of(key=signed(rows[0]), cls=signed(rows[1]), size=signed(rows[2]))

    return rows.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(task, "key bigint, cls bigint, size bigint").distinct()


def _folded(bits: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit numbers, folded to the shortest length."""
    shortest = min(map(len, bits))
    out = np.empty((len(bits), shortest // 8), np.uint64)
    for i, b in enumerate(bits):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, shortest // 8), axis=0)
    return out


def _forest(sizes: np.ndarray, sketches: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs that size and Hamming distance leave possible."""
    left, edges = np.arange(len(sizes)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            far = np.bitwise_count(sketches[left] ^ sketches[x]).sum(axis=1, dtype=np.int64)
            a, b = sizes[left], sizes[x]
            near = far * (num + den) <= (a + b) * (den - num)
            near &= np.minimum(a, b) * den >= np.maximum(a, b) * num
            if near.any():
                edges += [(x, int(y)) for y in left[near]]
                queue += left[near].tolist()
                left = left[~near]
    return edges


def _forests(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): forest links of every (key, x, y), from (key, x, y, cls, n_shingles, bits)."""

    def task(batches):
        seen: set[tuple[int, int]] = set()
        for table in runs(batches, ["key", "x", "y"]):
            names = [table.column(c).to_numpy() for c in ("key", "x", "y")]
            cls, n, bits = table.column("cls").to_numpy(), table.column("n_shingles").to_numpy(), table.column("bits").to_pylist()
            new = np.ones(len(cls), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in names])
            at = np.flatnonzero(new)
            found = []
            for a, b in zip(at, [*at[1:], len(cls)]):
                if b - a < 2:
                    continue
                ids = cls[a:b]
                if b - a == 2 and (int(ids[0]), int(ids[1])) in seen:
                    continue
                for i, j in _forest(n[a:b], _folded(bits[a:b]), num, den):
                    pair = (int(min(ids[i], ids[j])), int(max(ids[i], ids[j])))
                    if pair not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(pair)
                        found.append(pair)
            if found:
                a, b = zip(*found)
                yield batch_of(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "cls").mapInArrow(task, "a bigint, b bigint").distinct()


def _parted(met: DataFrame) -> DataFrame:
    """(key, x, y, cls): blocks of `met(key, cls, size)` in parts of about BLOCK_SETS sets."""
    part = F.pmod(F.xxhash64("key", "cls"), F.ceil(F.col("size") / BLOCK_SETS))
    return met.select("key", part.alias("x"), part.alias("y"), "cls")


def _crossing(met: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, x, y, cls): pairs of parts of the blocks above BLOCK_SETS that hold all pairs of sets in
    different `groups(item, cluster_id)`. Sets of a block's largest group don't meet each other."""
    large = met.where(F.col("size") > BLOCK_SETS)
    named = stage(large.join(groups.withColumnRenamed("item", "cls"), "cls", "left").select("key", "cls", "size", F.coalesce("cluster_id", "cls").alias("grp")))
    most = named.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max(F.struct("n", "grp")).alias("most"))
    most = most.select("key", F.col("most.n").alias("n"), F.col("most.grp").alias("main"))
    rows = named.join(most, "key").where(F.col("n") < F.col("size"))
    ours = F.ceil(F.col("n") / BLOCK_SETS)  # parts of the largest group: -1, -2, ...
    others = F.ceil((F.col("size") - F.col("n")) / BLOCK_SETS)  # parts of the rest: 0, 1, ...
    place = F.xxhash64("key", "cls")
    mine = F.when(F.col("grp") == F.col("main"), -1 - F.pmod(place, ours)).otherwise(F.pmod(place, others))
    first = F.when(F.col("grp") == F.col("main"), F.lit(0).cast("bigint")).otherwise(-ours)
    met = rows.select("key", "cls", mine.alias("mine"), F.explode(F.sequence(first, others - 1)).alias("other"))
    return met.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "cls")


def _candidates(met: DataFrame, one: DataFrame, num: int, den: int) -> DataFrame:
    """(item, cluster_id): groups that hold every linked pair, from `met(key, cls, size)` and
    `one(cls, n_shingles, bits)`."""
    links = fewer_links(_forests(_parted(met).join(one, "cls"), num, den))
    groups = components(links)
    if met.where(F.col("size") > BLOCK_SETS).isEmpty():
        return groups
    across = fewer_links(_forests(_crossing(met, groups).join(one, "cls"), num, den))
    return components(groups.select(F.col("item").alias("a"), F.col("cluster_id").alias("b")).unionByName(across))


def fewer_links(links: DataFrame) -> DataFrame:
    """Links with the same components as `links(a, b)`: parts of at most LINKS links are replaced by
    spanning forests. It saves rounds of the components their dense groups; no part is a component."""
    links = stage(links)
    parts = max(1, -(-links.count() // LINKS))

    def task(batches):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            kept = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    kept.append((a, b))
            if kept:
                a, b = zip(*kept)
                yield batch_of(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

    return links.repartition(parts, "a", "b").mapInArrow(task, "a bigint, b bigint")


def exact_links(ids: np.ndarray, sets: list[np.ndarray], num: int, den: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning links of the graph of all pairs with |A & B| / |A | B| >= num / den.

    Sets in order of size, shingles in order of rarity: two linked sets share one of their
    rarest n - ceil(n t) + 1. A pair is compared only if not connected already, where sets of one
    `known` group are connected from the start: postings are kept by group, and a few sets of each
    are tried before the rest of it.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sets = ids[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    token = rank[token]
    mark = np.zeros(len(count), bool)
    posting: dict[int, dict[int, list[int]]] = {}  # shingle -> group -> sets
    root = list(range(len(sets)))
    if known is not None:
        _, first, label = np.unique(known[order], return_index=True, return_inverse=True)
        root = first[label].tolist()
    links = []
    shared = np.sort(rank[count > 1])
    lone_below = shared[0] if len(shared) else len(count)  # ranks below: shingles of one set

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def compare(y: int, n: int, others: np.ndarray) -> None:
        others = others[sizes[others] * den >= n * num]
        for block in np.array_split(others, max(1, int(sizes[others].sum()) // 2_000_000)):
            if not len(block):
                continue
            both = np.add.reduceat(mark[np.concatenate([token[ends[x] - sizes[x] : ends[x]] for x in block])].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[block])[:-1]]))
            for x in block[den * both >= num * (sizes[block] + n - both)].tolist():
                a, b = find(x), find(y)
                if a != b:
                    links.append((int(ids[x]), int(ids[y])))
                    root[max(a, b)] = min(a, b)

    for y in range(len(sets)):
        mine = np.sort(token[ends[y] - sizes[y] : ends[y]])
        n = len(mine)
        prefix = mine[: n - -(-n * num // den) + 1]
        prefix = prefix[prefix >= lone_below].tolist()
        near: dict[int, list[list[int]]] = {}  # group -> its posting lists
        for t in prefix:
            found = posting.get(t)
            if not found:
                continue
            for r in [r for r in found if root[r] != r]:  # groups that have become one
                less, more = sorted((found.pop(r), found.get(find(r), [])), key=len)
                more += less
                found[find(r)] = more
            for r, members in found.items():
                if r != find(y):
                    near.setdefault(r, []).append(members)
        if near:
            mark[mine] = True
            compare(y, n, np.unique([x for lists in near.values() for members in lists[:TRIED] for x in members[-TRIED:]]))
            rest = [members for r, lists in near.items() if find(r) != find(y) for members in lists]
            if rest:
                compare(y, n, np.unique(np.concatenate([np.array(x) for x in rest])))
            mark[mine] = False
        own = find(y)
        for t in prefix:
            posting.setdefault(t, {}).setdefault(own, []).append(y)
    return links


def _rows_of(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(cand, cls, n, s, near) of the sets in `members(doc_id, cls, cand)`: `s` holds the shingles, `near`
    min-hashes that sets share with the chance of their similarity. Repeated rows repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(members, F.xxhash64("doc_id"), DOC_BITS))

    def wanted():
        memo = WordHashes()

        def run(batch):
            if batch is None:
                return []
            hit = has_bit(shared.value, batch.column("place").to_numpy())
            if not hit.any():
                return []
            batch = batch.filter(pa.array(hit))
            sets = [shingles(memo.of(lower_words(t)), k) for t in texts(batch)]
            near = [[int(mix(s ^ salt).min().astype(np.int64)) for salt in SALTS] if len(s) else None for s in sets]
            return [batch_of(doc_id=batch.column("doc_id"), cls=pa.array([set_key(s) for s in sets], pa.int64()), n=pa.array([len(s) for s in sets], pa.int64()), s=pa.array([s.tobytes() for s in sets], pa.binary()), near=pa.array(near, pa.list_(pa.int64())))]

        return run

    placed = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(DOC_BITS)))
    sets = map_arrow(placed, wanted, "doc_id bigint, cls bigint, n bigint, s binary, near array<bigint>")
    return sets.join(members.select("doc_id", "cls", "cand"), ["doc_id", "cls"]).drop("doc_id")


def _compared(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): exact spanning links inside every (cand, x, y), from (cand, x, y, cls, grp, s)."""

    def task(batches):
        for table in runs(batches, ["cand", "x", "y"]):
            names = [table.column(c).to_numpy() for c in ("cand", "x", "y")]
            cls, grp, s = table.column("cls").to_numpy(), table.column("grp").to_numpy(), table.column("s").to_pylist()
            new = np.ones(len(cls), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in names])
            once = new.copy()  # repeated rows have sent their set again
            once[1:] |= cls[1:] != cls[:-1]
            at = np.flatnonzero(new)
            found = []
            for a, b in zip(at, [*at[1:], len(cls)]):
                mine = a + np.flatnonzero(once[a:b])
                if len(mine) > 1:
                    found += exact_links(cls[mine], [np.frombuffer(s[i], np.uint64) for i in mine], num, den, grp[mine])
            if found:
                a, b = zip(*found)
                yield batch_of(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

    return rows.repartition("cand", "x", "y").sortWithinPartitions("cand", "x", "y", "cls").mapInArrow(task, "a bigint, b bigint")


def _dealt(rows: DataFrame, turn: int) -> DataFrame:
    """(cand, x, y, cls, grp, s): candidate groups in parts of at most about CHUNK_SHINGLES, sets of one
    min-hash together as far as that allows."""
    near = F.col("near")[turn]
    heavy = rows.groupBy("cand", near.alias("hash")).agg(F.sum("n").alias("mine"))
    total = heavy.groupBy("cand").agg(F.sum("mine").alias("total"))
    # staged: few rows, if any, and a join that knows it shuffles no sets
    sizes = stage(heavy.join(total.where(F.col("total") > CHUNK_SHINGLES), "cand"))
    half = CHUNK_SHINGLES // 2
    large = F.col("mine") > half
    place = F.when(F.col("total").isNull(), F.lit(0)).when(large, F.xxhash64("hash")).otherwise(F.pmod(F.xxhash64("hash"), F.ceil(F.col("total") / half)))
    part = F.when(large, 1 + F.pmod(F.xxhash64("cls"), F.ceil(F.col("mine") / half))).otherwise(F.lit(0))
    sizes = sizes.withColumnRenamed("cand", "of")
    joined = rows.join(sizes, (F.col("cand") == F.col("of")) & (near == F.col("hash")), "left")
    return joined.select("cand", place.cast("bigint").alias("x"), part.cast("bigint").alias("y"), "cls", F.col("cls").alias("grp"), "s")


def _across(rows: DataFrame, groups: DataFrame) -> DataFrame | None:
    """(cand, x, y, cls, grp, s): pairs of parts that hold all pairs of sets of a candidate group that are
    in different `groups(item, cluster_id)`; None if there are none. A candidate group's largest group
    doesn't meet itself, so what travels more than once is mostly what isn't connected yet."""
    named = rows.join(groups.withColumnRenamed("item", "cls"), "cls", "left").withColumn("grp", F.coalesce("cluster_id", "cls"))
    each = named.groupBy("cand", "grp").agg(F.sum("n").alias("mine"))
    most = each.groupBy("cand").agg(F.max(F.struct("mine", "grp")).alias("most"), F.sum("mine").alias("total"))
    most = stage(most.select("cand", F.col("most.mine").alias("mine"), F.col("most.grp").alias("main"), "total").where("mine < total"))
    if most.isEmpty():
        return None
    ours = F.ceil(F.col("mine") / CHUNK_SHINGLES)  # parts of the largest group: -1, -2, ...
    others = F.ceil((F.col("total") - F.col("mine")) / CHUNK_SHINGLES)  # parts of the rest: 0, 1, ...
    place, inside = F.xxhash64("cls"), F.col("grp") == F.col("main")
    part = F.when(inside, -1 - F.pmod(place, ours)).otherwise(F.pmod(place, others))
    first = F.when(inside, F.lit(0).cast("bigint")).otherwise(-ours)
    met = named.join(most, "cand").select("cand", "cls", "grp", "s", part.alias("part"), F.explode(F.sequence(first, others - 1)).alias("other"))
    return met.select("cand", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "cls", "grp", "s")


def _verified(docs: DataFrame, members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(item, cluster_id): sets with an exact link, from `members(doc_id, cls, cand, n_shingles)`, one row a set."""
    rows = stage(_rows_of(docs, members, k))
    links = fewer_links(_compared(_dealt(rows, 0), num, den))
    total = members.groupBy("cand").agg(F.sum("n_shingles").alias("total")).where(F.col("total") > CHUNK_SHINGLES).select("cand")
    large = stage(rows.join(total, "cand", "left_semi"))
    groups = components(links)
    if not large.isEmpty():
        for turn in range(1, len(SALTS)):
            links = _linking(groups).unionByName(fewer_links(_compared(_dealt(large, turn), num, den)))
            groups = components(links)
        across = _across(large, groups)
        if across is not None:
            groups = components(_linking(groups).unionByName(fewer_links(_compared(across, num, den))))
    drop(rows, large)
    return groups


def _linking(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("item").alias("a"), F.col("cluster_id").alias("b"))


def linked(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents link at Jaccard num / den."""
    return _linked(docs, k, num, den).drop("text_hash")


def _linked(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """`linked` with the hash of the row's text: rows of one doc_id can differ in it."""
    found = stage(document_sets(docs, k))
    met = stage(_meeting(document_blocks(docs, k, num, den)))
    one = stage(found.where(F.col("bits").isNotNull()).join(met.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits")))
    candidates = _candidates(met, one, num, den).withColumnRenamed("item", "cls").withColumnRenamed("cluster_id", "cand")
    least = found.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    members = stage(candidates.join(least, "cls"))
    drop(met, one)
    groups = _verified(docs, members, k, num, den)
    grouped = members.join(groups.withColumnRenamed("item", "cls"), "cls").select("cls", "cluster_id", "doc_id")
    lowest = grouped.groupBy("cluster_id").agg(F.min("doc_id").alias("component"))
    named = grouped.join(lowest, "cluster_id").select("cls", "component")
    # written, so that the join below has nothing but shuffles under it and a class of many copies is split
    out = stage(least.join(named, "cls", "left").select("cls", F.coalesce("component", "doc_id").alias("component")))
    return found.select("doc_id", "text_hash", "n_shingles", "cls").join(out, "cls", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )


@names_apart
def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """`docs` with one document of each group of linked ones: that with the smallest doc_id.

    Rows without doc_id or without words are linked with nothing and stay. Repeated rows of one
    doc_id and text count once; another text under the doc_id of one that goes is judged by itself.
    """
    groups = stage(_linked(docs, k, num, den))
    doc = F.col("doc_id").cast("bigint")
    pair = (F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"))
    gone = stage(groups.where(F.col("doc_id") != F.col("component_id")).select(*pair).distinct())
    again = stage(groups.where((F.col("doc_id") == F.col("component_id")) & (F.col("n_shingles") > 0)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("__doc")))
    repeated = groups.select(*pair).join(again, "__doc", "left_semi")
    single, docs = set_apart(docs, gone.unionByName(repeated))
    kept = docs.join(gone, (doc == F.col("__doc")) & (text_hash() == F.col("__text")), "left_anti")
    once = kept.join(again, doc == F.col("__doc"), "left_anti")
    return single.unionByName(once).unionByName(kept.join(again, doc == F.col("__doc"), "left_semi").dropDuplicates(["doc_id", "text"]))
