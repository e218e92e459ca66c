"""Structure repair of conversations by one integer minimum.

A conversation's rows are brought into order and edited so that their role initials read
`(s?(ua)+)?`. Each way to do so is a path through a graph whose nodes are (rows read, letters
written, role state); its edges are Keep, Rerole, Delete and Insert. A path's weight is one integer:
the cost in its high digits, below it a digit of fixed place for each letter of the audit string,
D < I < K < R, the first letter highest, zeros after the last. The ordinary minimum of these
integers is the cheapest path, and among those the one whose letters come first in ASCII order.

Rows stream through the graph. A node that costs more than the cheapest plus what it takes to get
from any state to any other can't win and goes, so about ten paths remain, each with the hash of
the rows it has kept; no row is held. See `Repair`.

Order is (turn, nulls first; role; text), so that ties fall alike every time. Null roles and texts
read as one blank. Equal rows are duplicates of each other; which one stays makes no difference. A
null conv_id is a conversation of its own. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from colsight.llm.common import map_arrow

# --- fixed values: edits in ASCII order, their digits, their costs -----------------------------------
LETTERS = "DIKR"
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5, "truncated": 5}
LEGAL_PAIRS = ("su", "ua", "au")
WHITE = b" \t\n\x0b\x0c\r"
SENTENCE_ENDS = b".!?"

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: b"user", ASSISTANT: b"assistant"}
BITS = 3  # a digit holds 0 (no letter) and the four letters
DIGIT = {letter: i for i, letter in enumerate(LETTERS, 1)}
RANK_BITS = 16  # more than there can be nodes
OPEN = 16  # rows read before letters are taken out


def damage_code() -> Column:
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return F.crc32(key.cast("binary")) % 20


def _rows(table: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return table.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )


def damaged(table: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): rows after damage; dropped ones stay with present = false.

    By crc32 of `conv_id:turn` mod 20: 0 drops the row, 1 empties its text, 2 removes its sentence
    ends, 3 repeats it, 4 makes its role user.
    """
    code = F.col("code")
    text = F.when(code == 0, "").when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _rows(table)
        .withColumn("code", damage_code())
        .select("conv_id", "turn", F.when(code == 4, "user").when(code == 0, "").otherwise(F.col("role")).alias("role"), text.alias("text"), (code != 0).alias("present"), F.explode(copies).alias("copy"))
        .drop("copy")
    )


def undamaged(table: DataFrame) -> DataFrame:
    """The same columns of rows as they are."""
    return _rows(table).withColumn("present", F.lit(True))


def _with_first_turn(rows: DataFrame) -> DataFrame:
    """Adds `first`: for a role and text that a conversation has several times, its least turn.

    Only hashes are grouped, combined on the map side; what occurs once has no first.
    """
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = rows.withColumn("same", F.when(F.col("present"), F.unhex(same)))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # nulls first
    again = keyed.where("present").groupBy("conv_id", "same").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("first")).where("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), F.col("first"))
    return keyed.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left").select(
        "conv_id", "turn", "role", "text", "present", (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("later")
    )


class Path:
    """The best way to a node: its weight, the letters taken out of it, the hash of its rows so far."""

    __slots__ = ("weight", "taken", "hash", "some")

    def __init__(self, weight: int, taken: tuple, hash, some: bool):
        self.weight, self.taken, self.hash, self.some = weight, taken, hash, some

    def step(self, weight: int, line: bytes | None) -> Path:
        if line is None:
            return Path(weight, self.taken, self.hash, self.some)
        longer = self.hash.copy()
        longer.update(b"\n" + line if self.some else line)
        return Path(weight, self.taken, longer, True)


Node = tuple[int, int]  # role state, letters written since the last were taken out


class Repair:
    """One conversation: rows go in; cost, audit and hash come out.

    A weight is cost | rank | letters. Every few rows the letters that all nodes have written are
    taken out and kept beside the node; the rank among the nodes of what was taken out stands for
    them, which leaves every comparison as it was. So the integers stay short, and a task holds a
    few paths, their letters and hashes, but no rows, however long a conversation is and however
    late its cheapest repair is decided.
    """

    def __init__(self, costs: dict[str, int]):
        if costs["I"] <= 0 or min(costs.values()) < 0:
            raise ValueError("an insert must cost something, and no cost may be below 0")
        self.cost = costs
        self.slack = 2 * costs["I"] + costs["D"]  # two inserts and a delete lead from any state to any other
        self.width = OPEN * (2 + self.slack // costs["I"])
        self.nodes: dict[Node, Path] = {(START, 0): Path(0, (), hashlib.sha256(), False)}
        self.spent = 0
        self.rows = 0

    def _weigh(self, weight: int, letter: str, place: int, cost: int) -> int:
        return weight + (cost << (BITS * self.width + RANK_BITS)) + (DIGIT[letter] << (BITS * (self.width - 1 - place)))

    def _least(self, offers: list[tuple[Node, int, Path, bytes | None]], nodes: dict[Node, Path]) -> dict[Node, Path]:
        """The least weight of each node, without nodes that can't win."""
        best: dict[Node, tuple[int, Path, bytes | None]] = {n: (x.weight, x, None) for n, x in nodes.items()}
        for node, weight, path, line in offers:
            if node not in best or weight < best[node][0]:
                best[node] = (weight, path, line)
        shift = BITS * self.width + RANK_BITS
        most = ((min(w for w, _, _ in best.values()) >> shift) + self.slack + 1) << shift
        return {n: nodes[n] if n in nodes and nodes[n].weight == w else x.step(w, line) for n, (w, x, line) in best.items() if w < most}

    def _with_inserts(self, nodes: dict[Node, Path]) -> dict[Node, Path]:
        """Any number of inserts; each costs something, so the slack ends them."""
        waiting = list(nodes)
        while waiting:
            offers = []
            for state, place in waiting:
                path, to = nodes[state, place], NEXT[state]
                offers.append(((to, place + 1), self._weigh(path.weight, "I", place, self.cost["I"]), path, ROLE[to] + b":"))
            more = self._least(offers, nodes)
            waiting = [n for n, x in more.items() if n not in nodes or nodes[n] is not x]
            nodes = more
        return nodes

    def row(self, role: str, text: bytes, must_go: bool, truncated: bool) -> None:
        extra = self.cost["truncated"] if truncated else 0
        own = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1])
        line = role.encode() + b":" + text
        offers = []
        for (state, place), path in self._with_inserts(self.nodes).items():
            offers.append(((state, place + 1), self._weigh(path.weight, "D", place, self.cost["D"]), path, None))
            if must_go:
                continue
            to = NEXT[state]
            if own == to or (own == SYSTEM and state == START):
                offers.append(((own, place + 1), self._weigh(path.weight, "K", place, self.cost["K"] + extra), path, line))
            offers.append(((to, place + 1), self._weigh(path.weight, "R", place, self.cost["R"] + extra), path, ROLE[to] + b":" + text))
        self.nodes = self._least(offers, {})
        self.rows += 1
        if self.rows % OPEN == 0:
            self._take_out()

    def _letters(self, weight: int, n: int) -> str:
        """The first n places."""
        return "".join(LETTERS[((weight >> (BITS * (self.width - 1 - i))) & 7) - 1] for i in range(n))

    def _take_out(self) -> None:
        n = min(place for _, place in self.nodes)
        digits, low = BITS * self.width, BITS * (self.width - n)
        prefixes = {node: ((x.weight >> low) & ((1 << (digits - low + RANK_BITS)) - 1)) for node, x in self.nodes.items()}
        rank = {prefix: i for i, prefix in enumerate(sorted(set(prefixes.values())))}
        taken: dict[int, tuple] = {}  # nodes with the same letters share them
        least = min(x.weight for x in self.nodes.values()) >> (digits + RANK_BITS)
        self.spent += least
        nodes = {}
        for (state, place), x in self.nodes.items():
            prefix = prefixes[state, place]
            if prefix not in taken:
                taken[prefix] = (x.taken, self._letters(x.weight, n))
            cost = (x.weight >> (digits + RANK_BITS)) - least
            rest = (x.weight & ((1 << low) - 1)) << (BITS * n)
            nodes[state, place - n] = Path((cost << (digits + RANK_BITS)) + (rank[prefix] << digits) + rest, taken[prefix], x.hash, x.some)
        self.nodes = nodes

    def end(self) -> tuple[int, str, str]:
        """Cost, audit, hash of the repaired rows."""
        ends = {n: x for n, x in self._with_inserts(self.nodes).items() if n[0] in (START, ASSISTANT)}
        (_, place), path = min(ends.items(), key=lambda x: x[1].weight)
        parts, at = [self._letters(path.weight, place)], path.taken
        while at:
            at, letters = at
            parts.append(letters)
        return self.spent + (path.weight >> (BITS * self.width + RANK_BITS)), "".join(reversed(parts)), path.hash.hexdigest()


class Conversation:
    """Counts of one conversation's rows in order, and their repair."""

    def __init__(self, conv_id: int | None, costs: dict[str, int]):
        self.conv_id, self.repair = conv_id, Repair(costs)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = self.last = None

    def row(self, turn: int | None, role: str, text: bytes, later: bool) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
                self.high = turn
            self.low = turn if self.low is None else self.low
        if self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = role[:1]
        seen, self.last = later or self.last == (turn, role, text), (turn, role, text)
        end = text.rstrip(WHITE)
        blank = not end
        cut = not blank and not seen and end[-1] not in SENTENCE_ENDS
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut
        self.repair.row(role, text, blank or seen, cut)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit, digest = self.repair.end()
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'bigint'}" for n in NAMES)
ARROW = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in NAMES])


def repair_rows(rows: DataFrame, costs: dict[str, int] | None = None) -> DataFrame:
    """One row a conversation of `rows(conv_id, turn, role, text, present)`; see `repair`."""
    costs = {**COSTS, **(costs or {})}
    ordered = _with_first_turn(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def make():
        now: list[Conversation] = []

        def run(batch):
            done = []
            if batch is None:
                done = [c.result() for c in now]
                now.clear()
            else:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                lists = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "present", "later"))
                for conv_id, turn, role, present, later, text in zip(*lists, texts):
                    if not now or now[0].conv_id != conv_id:
                        done += [c.result() for c in now]
                        now[:] = [Conversation(conv_id, costs)]
                    if present:
                        now[0].row(turn, role, text, later)
            if not done:
                return []
            return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), ARROW.types)], schema=ARROW)]

        return run

    return map_arrow(ordered, make, SCHEMA)


def repair(table: DataFrame, costs: dict[str, int] | None = None) -> DataFrame:
    """Faults and cheapest repair of every conversation of `table(conv_id, turn, role, text)` as it is."""
    return repair_rows(undamaged(table), costs)


def repair_damaged(table: DataFrame) -> DataFrame:
    """The same after the fixed damage; conversations that lose all rows give zeros."""
    return repair_rows(damaged(table))
