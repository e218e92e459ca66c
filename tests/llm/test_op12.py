"""Conversation repair against plain code: a table of cheapest edits for every prefix, with strings."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from colsight.llm import op12_repair as op12

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def show(x):
    return " " if x is None else str(x)


def damage(rows):
    for c, t, r, x in rows:
        r, x = show(r), show(x)
        code = zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        if code == 1:
            x = ""
        elif code == 2:
            x = re.sub("[.!?]", "", x)
        elif code == 4:
            r = "user"
        yield from [(c, t, r, x)] * (0 if code == 0 else 2 if code == 3 else 1)


def cheapest(rows, costs):
    """(cost, audit, lines) by trying every edit at every place; rows are (role, text, must_go, truncated)."""
    states = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):  # more inserts in a row are never cheaper
            for s, (cost, audit, lines) in list(best.items()):
                for role in states[s].replace("s", ""):
                    new = (cost + costs["I"], audit + "I", [*lines, names[role] + ":"])
                    if role not in best or new[:2] < best[role][:2]:
                        best[role] = new
        return best

    layers = inserted({"": (0, "", [])})
    for role, text, must_go, truncated in rows:
        after, extra = {}, costs["truncated"] if truncated else 0

        def offer(state, new):
            if state not in after or new[:2] < after[state][:2]:
                after[state] = new

        for s, (cost, audit, lines) in layers.items():
            offer(s, (cost + costs["D"], audit + "D", lines))
            if not must_go:
                if role[:1] and role[:1] in states[s]:
                    offer(role[:1], (cost + costs["K"] + extra, audit + "K", [*lines, f"{role}:{text}"]))
                for to in states[s].replace("s", ""):
                    offer(to, (cost + costs["R"] + extra, audit + "R", [*lines, f"{names[to]}:{text}"]))
        layers = inserted(after)
    return min((layers[s] for s in ("", "a") if s in layers), key=lambda x: x[:2])


def plain(rows, damaged=True, costs=op12.COSTS):
    ids = sorted({r[0] for r in rows}, key=repr)
    after = list(damage(rows)) if damaged else [(c, t, show(r), show(x)) for c, t, r, x in rows]
    out = []
    for c in ids:
        own = sorted((r for r in after if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        seen, blank, duplicate, truncated, work = set(), 0, 0, 0, []
        for _, _, role, text in own:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "duplicate"), truncated + (fault == "truncated")
            work.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(work, costs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def some(seed, n, roles=("user", "assistant", "system", "tool", "", None, "unicorn"), longest=14):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        at = 0
        for i in range(rnd.randint(1, longest)):
            at += rnd.choice([0, 1, 1, 1, 1, 2])
            tidy = rnd.random() < 0.6
            role = ("user", "assistant")[i % 2] if tidy else rnd.choice(roles)
            text = rnd.choice(["Hi there.", "No end", "", " \n", None, "Why?", "é!", "A. b", f"Row {i}.", f"Row {i}!\t", " "])
            rows.append((c, at if rnd.random() < 0.95 else None, role, text))
    rnd.shuffle(rows)
    return rows


def test_damaged(spark, rows):
    data = some(1, 150) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (None, None, None, None)]
    assert rows(op12.repair_damaged(spark.createDataFrame(data, SCHEMA).repartition(3))) == plain(data)


@pytest.mark.parametrize("costs", [{}, {"D": 20}, {"I": 1, "D": 3}, {"I": 1, "D": 9, "R": 4}, {"K": 1, "R": 1, "truncated": 0}])
def test_other_costs(spark, rows, costs):
    data = some(3, 60, longest=9)
    assert rows(op12.repair(spark.createDataFrame(data, SCHEMA), costs)) == plain(data, False, {**op12.COSTS, **costs})


def test_long_conversation_keeps_few_paths():
    rnd = random.Random(4)
    run, work, most = op12.Repair(op12.COSTS), [], 0
    for i in range(6000):
        role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.3 else ("user", "assistant")[i % 2]
        work.append((role, f"t{i}.", rnd.random() < 0.05, rnd.random() < 0.1))
        run.row(work[-1][0], work[-1][1].encode(), work[-1][2], work[-1][3])
        most = max(most, len(run.nodes), max(x.weight for x in run.nodes.values()).bit_length() // 10)
    cost, audit, digest = run.end()
    want = cheapest(work, op12.COSTS)
    assert (cost, audit, digest) == (want[0], want[1], hashlib.sha256("\n".join(want[2]).encode()).hexdigest())
    assert most < 60


@pytest.mark.parametrize("roles", [["user"], ["tool"], ["assistant"], ["system"], ["assistant", "user"]])
def test_long_runs_of_one_kind(roles):
    """Here the ways stay equally cheap for long; width grows, results are the same."""
    for n in (1, 2, 3, 7, 250, 251):
        run = op12.Repair(op12.COSTS)
        work = [(roles[i % len(roles)], f"t{i}.", False, False) for i in range(n)]
        for role, text, must_go, truncated in work:
            run.row(role, text.encode(), must_go, truncated)
        want = cheapest(work, op12.COSTS)
        assert run.end() == (want[0], want[1], hashlib.sha256("\n".join(want[2]).encode()).hexdigest())


def test_edges(spark, rows):
    empty = hashlib.sha256(b"").hexdigest()
    assert rows(op12.repair_damaged(spark.createDataFrame([], SCHEMA))) == []
    dropped = next((c, t) for c in range(1000) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(*dropped, "user", "Hi.")], SCHEMA)
    assert rows(op12.repair_damaged(one)) == [(dropped[0], 0, 0, 0, 0, 0, 0, "", empty)]
    names = ["code", "copy", "present", "later", "same", "first", "known", "c", "s", "n", "gaps", "audit"]
    data = some(5, 10)
    wide = spark.createDataFrame([(*r, *["z"] * len(names)) for r in data], SCHEMA + ", " + ", ".join(f"{n} string" for n in names))
    assert rows(op12.repair_damaged(wide)) == plain(data)
    long = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes.")]
    assert rows(op12.repair(spark.createDataFrame(long, SCHEMA))) == plain(long, False)


def test_whole_table(spark, rows):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert rows(op12.repair_damaged(table)) == plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
