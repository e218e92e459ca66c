"""Plain versions of the operators, on lists."""

import re
from collections import Counter, defaultdict
from hashlib import sha256

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    data = (text or "").encode()
    return WORDS.findall(data.lower() if lower else data)


def kept(docs, window, within):
    """(doc_id, n_words, n_removed, kept words) with a word gone if a window over it starts earlier."""
    first = {}
    rows = [(d, words(t)) for d, t in docs]
    for d, w in rows:
        if d is None:
            continue
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for d, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if d is not None and (first[k] < (d, i) if within else first[k][0] < d):
                gone[i : i + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), len(w) - len(left), b" ".join(left)))
    return out


def kept_digests(docs, window, within):
    return [(d, n, gone, sha256(left).hexdigest()) for d, n, gone, left in kept(docs, window, within)]


def shingle_set(text, k):
    w = words(text, True)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(docs, k, num, den):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(d, shingle_set(t, k)) for d, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for j in range(i):
            b, t = sets[j]
            if a is not None and b is not None and s and t and den * len(s & t) >= num * len(s | t):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(s), None if d is None else min(least[find(i)]) if s else d) for i, (d, s) in enumerate(sets)]


def contained(docs, items, k=5, threshold=0.8):
    """{(doc_id, item_id, n_shared, n_item)}; items of fewer words are one shingle of them all."""
    out = set()
    for d, t in docs:
        w = words(t, True)
        mine = {tuple(w[i : i + m]) for m in {min(k, len(words(x))) for _, x in items} for i in range(len(w) - m + 1)}
        for i, text in items:
            if d is not None and words(text):
                s = shingle_set(text, k)
                if len(s & mine) >= threshold * len(s) - 1e-12:
                    out.add((d, i, len(s & mine), len(s)))
    return out


def measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)
