"""Repair of a conversation's structure: the cheapest edits, found by Hirschberg's divide and conquer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.ordered import with_order
from headrace.llm.tables import Workspace, ship_library

# What a conversation may look like after each of its turns: nothing yet, a system turn, asked, answered.
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
# The turn that an insertion or a change of role makes, and the insertions that end a conversation.
_NEXT = {START: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
_ENDING = {START: "", SYSTEM: "II", ASKED: "I", ANSWERED: ""}
ROLE = {ASKED: "user", ANSWERED: "assistant"}

INITIALS = "sua?"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATION = 3
_FAR = 1 << 40

WHITE = " \t\n\x0b\x0c\r"

# Rows in a block, and blocks under one node of the tree above.
BLOCK_BITS = 10

Step = tuple[tuple[int, ...], tuple]


def _step(initial: str, fault: int) -> Step:
    """What a row does between each two states: the least cost, and the least edits of that cost.

    The edits are insertions before the row and the one that takes it in, so none begins another.
    """
    costs, words = [_FAR] * 16, ["~"] * 16
    for before in STATES:
        state = before
        for inserted in range(3):
            for edit in "DKR":
                after = {"D": state, "K": _AFTER.get((state, initial)), "R": _NEXT[state]}[edit]
                if after is None or (edit != "D" and fault in (BLANK, DUPLICATE)):
                    continue
                cost = inserted * COSTS["I"] + COSTS[edit] + (TRUNCATION if fault == TRUNCATED and edit != "D" else 0)
                at = 4 * before + after
                costs[at], words[at] = min((costs[at], words[at]), (cost, "I" * inserted + edit))
            state = _NEXT[state]
    return tuple(costs), tuple(words)


# One for each initial and fault, numbered 4 * initial + fault.
STEPS: list[Step] = [_step(initial, fault) for initial in INITIALS for fault in range(4)]


@lru_cache(1 << 14)
def _onward(costs: tuple[int, ...], ranks: tuple[int, ...], step: Step) -> tuple[tuple[int, ...], tuple[int, ...]]:
    weight, word = step
    best = [min((costs[before] + weight[4 * before + after], ranks[before], word[4 * before + after]) for before in STATES)
            for after in STATES]
    order = sorted(STATES, key=lambda state: best[state][1:])
    return tuple(min(cost, _FAR) for cost, _, _ in best), tuple(order.index(state) for state in STATES)


@lru_cache(1 << 14)
def _back(costs: tuple[int, ...], step: Step) -> tuple[int, ...]:
    weight = step[0]
    return tuple(min(min(weight[4 * before + after] + costs[after] for after in STATES), _FAR) for before in STATES)


def _lowered(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs less their least: few such vectors occur, so that most steps are known already."""
    least = min(costs)
    return (costs, 0) if not least or least >= _FAR else (tuple(c - least if c < _FAR else _FAR for c in costs), least)


def forward(steps: list[Step], low: int, high: int, costs: tuple, ranks: tuple) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Costs of the four states after some steps, and the order of their audits.

    The audits of two states never begin alike and end one within the other, as each takes in the same rows:
    so the order of two audits is settled where they first differ, whatever follows.
    """
    total = 0
    for i in range(low, high):
        costs, least = _lowered(costs)
        total += least
        costs, ranks = _onward(costs, ranks, steps[i])
    return tuple(c + total if c < _FAR else _FAR for c in costs), ranks


def backward(steps: list[Step], low: int, high: int, costs: tuple) -> tuple[int, ...]:
    """Costs from the four states before some steps to the end."""
    total = 0
    for i in range(high - 1, low - 1, -1):
        costs, least = _lowered(costs)
        total += least
        costs = _back(costs, steps[i])
    return tuple(c + total if c < _FAR else _FAR for c in costs)


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else _FAR for s in STATES)


def crossings(steps: list[Step], first: int, last: int) -> list[int]:
    """The states between the steps of the cheapest way from one state to another, of the least audit.

    Forward and backward costs meet in the middle; of the states with the least sum the one whose audit
    so far comes first is crossed, and both halves are solved alike. Only the states are kept.
    """
    states = [first] + [last] * len(steps)
    waiting = [(0, len(steps))]
    while waiting:
        low, high = waiting.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        costs, ranks = forward(steps, low, middle, _only(states[low]), (0,) * 4)
        rest = backward(steps, middle, high, _only(states[high]))
        states[middle] = min(STATES, key=lambda state: (costs[state] + rest[state], ranks[state]))
        waiting += [(low, middle), (middle, high)]
    return states


def joined(steps: list[Step]) -> Step:
    """Many steps as one, with the order of the audits in place of the audits."""
    costs, ranks = [], []
    for state in STATES:
        cost, rank = forward(steps, 0, len(steps), _only(state), (0,) * 4)
        costs += cost
        ranks += rank
    return tuple(costs), tuple(ranks)


def last_state(whole: Step) -> int:
    """Where the cheapest way through a whole conversation ends, before the insertions that end it."""
    costs, ranks = whole
    return min(STATES, key=lambda state: (costs[state] + COSTS["I"] * len(_ENDING[state]), ranks[state]))


def words_between(kinds: list[int], first: int, last: int) -> list[str]:
    """The edits of each row on the cheapest way between two states."""
    steps = [STEPS[k] for k in kinds]
    states = crossings(steps, first, last)
    return [step[1][4 * a + b] for step, a, b in zip(steps, states, states[1:])]


def audit_of(kinds: list[int]) -> str:
    """The audit of a whole conversation, from its rows' kinds."""
    last = last_state(joined([STEPS[k] for k in kinds]))
    return "".join(words_between(kinds, START, last)) + _ENDING[last]


def damaged(turns: DataFrame) -> DataFrame:
    """The rows (_key, conv_id, turn, role, text) of conversations after damage by a hash of conversation and turn.

    A null role or text is one space, and so is a null id or turn in what is hashed.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select(
        key_of("conv_id").alias("_key"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_harm"))
    harm = F.col("_harm")
    copies = F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(harm != 0).select(
        "_key", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy")).drop("_copy")


def key_of(name: str) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("+"), F.col(name).cast("string")), F.lit(""))


def _kinds(rows: DataFrame) -> DataFrame:
    """Places and kinds of the rows, without their texts. A role and text seen earlier is a duplicate."""
    initial = F.col("_initial")
    firsts = rows.groupBy("_key", "_same").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_first"))
    fault = (F.when(F.col("_last") == "", BLANK).when(F.col("_first").isNull(), DUPLICATE)
             .when(F.col("_last").isin(".", "!", "?"), SOUND).otherwise(TRUNCATED))
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (rows.select("_key", "_at", "_initial", "_last").join(firsts, "_at", "left")
            .select("_key", "_at", (number * 4 + fault).cast("int").alias("kind")))


def _as_step(node: dict) -> Step:
    return tuple(node["costs"]), tuple(node["ranks"])


_NODE = "costs array<long>, ranks array<int>"


_NODES = f"array<struct<{_NODE.replace(' ', ':')}>>".replace(",:", ",")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node's children as one step: rows of a block by their kinds, or nodes by their own steps."""
    for batch in batches:
        if "kinds" in batch.schema.names:
            found = [joined([STEPS[k] for k in kinds.as_py()]) for kinds in batch.column("kinds")]
        else:
            found = [joined([_as_step(n) for n in nodes.as_py()]) for nodes in batch.column("nodes")]
        columns = [pa.array([costs for costs, _ in found], pa.list_(pa.int64())),
                   pa.array([ranks for _, ranks in found], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "costs", "ranks"])


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before and after each child of a node; a whole conversation's last one is chosen here."""
    for batch in batches:
        ways = []
        for nodes, costs, ranks, first, last in zip(*(batch.column(c) for c in ("nodes", "costs", "ranks", "first", "last"))):
            end = last.as_py()
            if end is None:
                end = last_state((costs.as_py(), ranks.as_py()))
            ways.append(crossings([_as_step(n) for n in nodes.as_py()], first.as_py(), end))
        yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_n"), pa.array(ways, pa.list_(pa.int32()))],
                                         ["_key", "_n", "states"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [words_between(kinds.as_py(), first.as_py(), last.as_py())
                 for kinds, first, last in zip(*(batch.column(c) for c in ("kinds", "first", "last")))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("_key", "_from", "kinds")), pa.array(words, pa.list_(pa.string()))],
            ["_key", "_from", "kinds", "words"])


def row_edits(work: Workspace, kinds: DataFrame) -> DataFrame:
    """Rows (_key, _at, kind, word): the edits that each row (_key, _at, kind) takes part in.

    A conversation is a tree of blocks of rows. Upwards every block becomes one step between the four
    states; downwards each node finds the states between its children, and the blocks the edits of
    their rows. No task holds more than 1,024 rows or blocks at once, however long a conversation.
    """
    row = F.struct("_at", "kind")
    blocks = (kinds.groupBy("_key", F.shiftright("_at", BLOCK_BITS)).agg(F.sort_array(F.collect_list(row)).alias("rows"))
              .select("_key", F.col("rows")[0]["_at"].alias("_from"), F.transform("rows", lambda r: r["kind"]).alias("kinds")))
    order = Window.partitionBy("_key").orderBy("_from")
    blocks = work.save(blocks.withColumn("_n", F.row_number().over(order) - 1)
                       .mapInArrow(_tables, f"_key string, _from long, kinds array<int>, _n int, {_NODE}"))
    levels, nodes = [], blocks
    while not levels or (nodes.agg(F.max("_n")).first()[0] or 0) > 0:
        children = F.sort_array(F.collect_list(F.struct("_n", "costs", "ranks")))
        grouped = nodes.groupBy("_key", F.shiftright("_n", BLOCK_BITS).alias("_up")).agg(children.alias("children"))
        steps = F.transform("children", lambda n: F.struct(n["costs"].alias("costs"), n["ranks"].alias("ranks")))
        nodes = work.save(grouped.select("_key", F.col("_up").alias("_n"), steps.alias("nodes"))
                          .mapInArrow(_tables, f"_key string, _n int, nodes {_NODES}, {_NODE}"))
        levels.append(nodes)
    ways = nodes.select("*", F.lit(START).alias("first"), F.lit(None).cast("int").alias("last"))
    for below in (*reversed(levels[:-1]), blocks):
        solved = ways.mapInArrow(_ways, "_key string, _n int, states array<int>")
        pairs = F.transform(F.slice("states", F.lit(1), F.size("states") - 1), lambda state, i: F.struct(
            (F.col("_n") * (1 << BLOCK_BITS) + i).alias("_n"), state.alias("first"), F.get("states", i + 1).alias("last")))
        children = work.save(solved.select("_key", F.explode(pairs).alias("child")).select("_key", "child.*"))
        ways = below.join(children, ["_key", "_n"])
    words = ways.mapInArrow(_words, "_key string, _from long, kinds array<int>, words array<string>")
    return words.select("_key", "_from", "kinds", F.posexplode("words").alias("_i", "word")).select(
        "_key", (F.col("_from") + F.col("_i")).alias("_at"), F.get("kinds", "_i").alias("kind"), "word")


class _Conversation:
    """Counts, audit and running digest of one conversation, row by row."""

    def __init__(self, key: str):
        self.key, self.state, self.audit, self.cost = key, START, [], 0
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.least = self.most = None
        self.turns, self.sha, self.written = 0, hashlib.sha256(), False

    def _turn(self, role: str, text: str) -> None:
        self.sha.update(f"{'\n' if self.written else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written = True

    def _insert(self, edits: str) -> None:
        for _ in edits:
            self.state = _NEXT[self.state]
            self.cost += COSTS["I"]
            self._turn(ROLE[self.state], "")

    def add(self, turn: int | None, role: str, text: str, kind: int, word: str) -> None:
        fault, edit = kind % 4, word[-1]
        self.faults[fault] += 1
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.audit.append(word)
        self._insert(word[:-1])
        self.cost += COSTS[edit] + (TRUNCATION if fault == TRUNCATED and edit != "D" else 0)
        if edit == "K":
            self.state = _AFTER[self.state, role[:1]]
            self._turn(role, text)
        elif edit == "R":
            self.state = _NEXT[self.state]
            self._turn(ROLE[self.state], text)

    def result(self) -> dict:
        ending = _ENDING[self.state]
        self._insert(ending)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"_key": self.key, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audit) + ending, "repaired_sha256": self.sha.hexdigest()}


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = "_key string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_ARROW = pa.schema([("_key", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations one after another, each row behind its edits; none is held."""
    now, kind, word, done = None, None, None, []
    for batch in batches:
        columns = [batch.column(c) for c in ("_key", "kind", "word", "turn", "role", "text")]
        for i in range(batch.num_rows):
            key, *edits = (c[i].as_py() for c in columns[:3])
            if edits[0] is not None:
                kind, word = edits
                continue
            if now is None or now.key != key:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(key)
            now.add(*(c[i].as_py() for c in columns[3:]), kind, word)
        if len(done) >= 1024:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
            done = []
    if now is not None:
        done.append(now.result())
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_ARROW)


def repaired(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """What is wrong with each conversation and the cheapest edits that mend it.

    `rows` (_key, turn, role, text; see `key_of`) are the conversations as they came in: by default
    `conversations` as `damaged` leaves them. They go by turn, nulls first, and those of one turn by a
    hash of role and text; repeated rows are repeated turns. Faults of a row, the first counts: blank (no
    text but white space), duplicate (role and text seen earlier), truncated (no full stop, question or
    exclamation mark at its end). Edits: Keep 0, Rerole to user or assistant 3, Delete 4, which blank and
    duplicate rows must be, Insert an empty user or assistant turn 3; truncated rows that stay cost 3 more. The
    roles' initials must come to `(s?(ua)+)?`; of the cheapest audits the first by ASCII is taken.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every id in
    `conversations`, a null one included; zeros, an empty audit and the digest of nothing where no row is left.
    Other columns are ignored; no rows give no rows.

    The digest of a conversation can only be taken in order, so its rows pass through one task, one at a time;
    all before works on blocks of rows.
    """
    spark = conversations.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    rows = damaged(conversations) if rows is None else rows
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = with_order(work, rows.select(
        "_key", "turn", "role", "text", same.alias("_same"), F.substring("role", 1, 1).alias("_initial"),
        F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1).alias("_last"),
        F.monotonically_increasing_id().alias("_row")), "_key", "turn", "_same", "_row")
    edits = row_edits(work, _kinds(placed))
    told = (placed.select("_key", "_at", "turn", "role", "text").unionByName(edits, allowMissingColumns=True)
            .repartition("_key").sortWithinPartitions("_key", "_at", F.col("word").isNull())
            .mapInArrow(_told, _RESULT))
    ids = conversations.select(key_of("conv_id").alias("_key"), "conv_id").distinct()
    result = ids.join(told, "_key", "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()} | dict.fromkeys(_COUNTS, 0)
    return result.select("conv_id", *[F.coalesce(F.col(c), F.lit(empty[c]).cast(result.schema[c].dataType)).alias(c)
                                      for c in (*_COUNTS, "audit", "repaired_sha256")])
