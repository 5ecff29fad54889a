"""Conversation structure repair: generalised LR parsing with weighted edits over the role grammar.

A conversation's roles, as initials, should read `(s?(ua)+)?`.  The grammar below becomes an SLR table; a stack is a
node of a graph-structured stack (state, node below), and equal stacks are one node.  Every row is kept, reroled or
deleted, and rows may be inserted before it; of all ways that lead to one stack top the one with the smallest
(cost, audit) stays, the audit being the actions' initials D, I, K, R.  Two audits of one frontier end with the action
on the same row, so none is a prefix of another and their order never changes later: a frontier is a list of stack tops
in the order of their audits with costs above the least.  There are finitely many of those, so a row is one look-up
once its kind of step has been seen.

Scale: rows are sorted by range partition, so a long conversation lies in several.  Conversations inside a partition
are repaired there.  Those that touch an end of a partition are segments: each gives the costs from every stack to
every stack, a conversation's segments (at most as many as partitions) are chained, and each segment is run again
between the two stacks that the chain found.  No task holds more than a partition's part of a conversation.

Rows are in order of turn (nulls first), role, the text's first 32 characters, then the text's hash and the text;
nulls in role or text count as one space.  A null conversation id is a conversation like any other.  Rows that agree in
all of these are one row with a multiplicity until they are reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tradewind.llm.common import ship, staged

RULES = (("dialog", ()), ("dialog", ("s", "turns")), ("dialog", ("turns",)), ("turns", ("turns", "u", "a")), ("turns", ("u", "a")))
ROLE_OF = {"u": "user", "a": "assistant"}
RETURN, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; a kept or reroled truncated row adds the last
END = "$"
SPACES = " \t\n\v\f\r"
NAMES = {"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}
OUT_ROWS = 4096


class Stacks:
    """SLR table of a grammar and the nodes of its graph-structured stack."""

    def __init__(self, rules=RULES) -> None:
        self.rules = rules
        self.made = {left for left, _ in rules}
        self.terminals = sorted({x for _, right in rules for x in right} - self.made)
        self.start = rules[0][0]
        follow = self._follow()
        first = self._closure({(("", (self.start,)), 0)})
        self.states, self.goto, self.reductions = [first], {}, {}
        at = 0
        while at < len(self.states):
            items = self.states[at]
            for symbol in sorted({right[dot] for (_, right), dot in items if dot < len(right)}):
                moved = self._closure({(rule, dot + 1) for rule, dot in items if dot < len(rule[1]) and rule[1][dot] == symbol})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[at, symbol] = self.states.index(moved)
            for (left, right), dot in items:
                if dot == len(right) and left:
                    for ahead in follow[left]:
                        self.reductions.setdefault((at, ahead), []).append((left, len(right)))
            at += 1
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.number = {(0, -1): 0}
        self.moved: dict[tuple[int, str], list[int]] = {}
        for node in self._growing():  # every stack that some input leads to
            for t in self.terminals:
                self.advance(node, t)

    def _growing(self) -> Iterator[int]:
        at = 0
        while at < len(self.nodes):
            yield at
            at += 1

    def _closure(self, items: set) -> frozenset:
        found = set(items)
        while True:
            wanted = {right[dot] for (_, right), dot in found if dot < len(right)} & self.made
            more = {(rule, 0) for rule in self.rules if rule[0] in wanted} - found
            if not more:
                return frozenset(found)
            found |= more

    def _follow(self) -> dict[str, set[str]]:
        """Symbols after each made one.  Made symbols are taken to begin with what their rules begin with."""
        begins = {x: {x} for x in self.terminals} | {x: set() for x in self.made}
        follow = {x: set() for x in self.made}
        follow[self.start].add(END)
        for _ in range(len(self.rules) + len(self.made)):
            for left, right in self.rules:
                if right:
                    begins[left] |= begins[right[0]]
                for x, y in zip(right, right[1:]):
                    if x in self.made:
                        follow[x] |= begins[y]
                if right and right[-1] in self.made:
                    follow[right[-1]] |= follow[left]
        return follow

    def push(self, state: int, below: int) -> int:
        node = (state, below)
        if node not in self.number:
            self.number[node] = len(self.nodes)
            self.nodes.append(node)
        return self.number[node]

    def _reduced(self, node: int, ahead: str) -> set[int]:
        """The stacks that reductions before `ahead` give, the given one included."""
        found, todo = {node}, [node]
        while todo:
            top = todo.pop()
            for left, size in self.reductions.get((self.nodes[top][0], ahead), ()):
                base = top
                for _ in range(size):
                    base = self.nodes[base][1]
                to = self.goto.get((self.nodes[base][0], left))
                if to is not None and (new := self.push(to, base)) not in found:
                    found.add(new)
                    todo.append(new)
        return found

    def advance(self, node: int, terminal: str) -> list[int]:
        if (node, terminal) not in self.moved:
            out = set()
            for top in self._reduced(node, terminal):
                to = self.goto.get((self.nodes[top][0], terminal))
                if to is not None:
                    out.add(self._settled(self.push(to, top)))
            self.moved[node, terminal] = sorted(out)
        return self.moved[node, terminal]

    def _settled(self, node: int) -> int:
        """A state that can only reduce, and by one rule, does so at once."""
        while True:
            items = self.states[self.nodes[node][0]]
            if len(items) != 1:
                return node
            (((left, right), dot),) = items
            if dot < len(right) or not left:
                return node
            for _ in right:
                node = self.nodes[node][1]
            node = self.push(self.goto[self.nodes[node][0], left], node)

    def accepts(self, node: int) -> bool:
        done = self.goto.get((0, self.start))
        return any(self.nodes[top] == (done, 0) for top in self._reduced(node, END))


class Editor:
    """Cheapest edits of a sequence of row kinds: (initial, fault) with fault '' (none), 't' (truncated) or 'd' (to be deleted)."""

    def __init__(self) -> None:
        self.stacks = Stacks()
        self.options: dict[tuple[int, str, str], list] = {}
        self.steps: dict[tuple, tuple] = {}
        self.final: dict[int, tuple | None] = {}

    def _inserts(self, node: int) -> dict[int, tuple[int, str, tuple]]:
        """Stacks after insertions before a row: cost, audit and edits of the cheapest way."""
        found, todo = {node: (0, "", ())}, [node]
        while todo:
            at = todo.pop(0)
            cost, audit, edits = found[at]
            for t in ROLE_OF:
                for new in self.stacks.advance(at, t):
                    way = (cost + INSERT, audit + "I", (*edits, ("I", ROLE_OF[t])))
                    if new not in found or way < found[new]:
                        found[new] = way
                        todo.append(new)
        return found

    def _ways(self, node: int, initial: str, fault: str) -> list[tuple[int, int, str, tuple]]:
        """(stack, cost, audit, edits) over one row, the best for each stack."""
        key = (node, initial, fault)
        if key not in self.options:
            # a deletion comes before insertions: the same result at the same cost with the smaller audit
            best = {node: (DELETE, "D", (("D", None),))}
            if fault != "d":
                extra = TRUNCATED if fault == "t" else 0
                for at, (cost, audit, edits) in self._inserts(node).items():
                    for t in self.stacks.terminals:
                        keep = t == initial
                        if not keep and t not in ROLE_OF:
                            continue
                        more, letter, role = (0, "K", None) if keep else (RETURN, "R", ROLE_OF[t])
                        way = (cost + more + extra, audit + letter, (*edits, (letter, role)))
                        for new in self.stacks.advance(at, t):
                            if new not in best or way[:2] < best[new][:2]:
                                best[new] = way
            self.options[key] = [(new, *way) for new, way in best.items()]
        return self.options[key]

    def step(self, frontier: tuple, initial: str, fault: str) -> tuple[tuple, int, tuple]:
        """The next frontier, what the least cost grew by, and for each of its tops (place in the old frontier, edits)."""
        key = (frontier, initial, fault)
        if key not in self.steps:
            best: dict[int, tuple] = {}
            for place, (node, cost) in enumerate(frontier):
                for new, more, audit, edits in self._ways(node, initial, fault):
                    way = (cost + more, place, audit, edits)
                    if new not in best or way[:3] < best[new][:3]:
                        best[new] = way
            least = min(w[0] for w in best.values())
            order = sorted(best.items(), key=lambda x: x[1][1:3])
            self.steps[key] = (
                tuple((new, w[0] - least) for new, w in order), least, tuple((w[1], w[3]) for _, w in order))
        return self.steps[key]

    def run(self, start: int, kinds: list[tuple[str, str, int]]) -> tuple[tuple, int, list[tuple]]:
        """The last frontier, its least cost and the way back.  A kind's third part is its multiplicity: copies after
        the first are deleted, whatever the stack."""
        frontier, total, back = ((start, 0),), 0, []
        for initial, fault, times in kinds:
            frontier, more, ways = self.step(frontier, initial, fault)
            total += more + DELETE * (times - 1)
            back.append(ways)
        return frontier, total, back

    def end(self, frontier: tuple) -> tuple[int, int, tuple]:
        """Place in the frontier, cost and insertions of the cheapest accepted end."""
        best = None
        for place, (node, cost) in enumerate(frontier):
            if node not in self.final:
                ends = [way for at, way in self._inserts(node).items() if self.stacks.accepts(at)]
                self.final[node] = min(ends) if ends else None
            tail = self.final[node]
            if tail and (best is None or (cost + tail[0], place, tail[1]) < best[:3]):
                best = (cost + tail[0], place, tail[1], tail[2])
        return best[1], best[0], best[3]

    @staticmethod
    def trace(back: list[tuple], place: int) -> list[tuple]:
        """The edits of every row on the way to `place` of the last frontier."""
        edits = [()] * len(back)
        for i in range(len(back) - 1, -1, -1):
            place, edits[i] = back[i][place]
        return edits


@lru_cache(maxsize=1)
def editor() -> Editor:
    return Editor()


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


def own_fault(text: str) -> str | None:
    body = text.rstrip(SPACES)
    return "blank" if not body else None if body[-1] in ".!?" else "truncated"


KIND = {None: "", "truncated": "t", "blank": "d", "duplicate": "d"}
EDITS = "conv {kind}, part int, place bigint, action string, turn bigint, role string, repaired_role string, text string, fault string, times bigint"


class _Writer:
    """Collects output rows and hands them on as batches."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows = schema, []

    def full(self, least: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
        if self.rows and len(self.rows) >= least:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows = []


def _report(conv, part: int, rows: list[tuple], edits: list[tuple], tail: tuple) -> Iterator[tuple]:
    """Output rows of one run: rows are (turn, role, text, fault, times)."""
    place = 0
    for (turn, role, text, fault, times), done in zip(rows, edits):
        for letter, new_role in done:
            place += 1
            if letter == "I":
                yield conv, part, place, NAMES[letter], None, None, new_role, "", None, 1
            else:
                yield conv, part, place, NAMES[letter], turn, role, role if letter == "K" else new_role, text, fault, 1
        if times > 1:
            place += 1
            yield conv, part, place, NAMES["D"], turn, role, None, text, "blank" if fault == "blank" else "duplicate", times - 1
    for letter, new_role in tail:
        place += 1
        yield conv, part, place, NAMES[letter], None, None, new_role, "", None, 1


def _kinds(rows: list[tuple]) -> list[tuple[str, str, int]]:
    return [(initial_of(role), KIND[fault], times) for _, role, _, fault, times in rows]


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _first_pass(schema: pa.Schema):
    """Repairs the conversations inside a partition; the rows of its first and last one go on without an action."""

    def work(batches):
        own, out, part = editor(), _Writer(schema), TaskContext.get().partitionId()
        conv, run, at, begun, edge, seen = None, [], 0, False, True, set()
        for batch in batches:
            for key, turn, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or key != conv:
                    if begun and not edge:
                        frontier, _, back = own.run(0, _kinds(run))
                        place, _, tail = own.end(frontier)
                        out.rows += _report(conv, part, run, own.trace(back, place), tail)
                    edge = not begun
                    conv, run, at, begun, seen = key, [], 0, True, set()
                fault = own_fault(text)
                if fault != "blank":
                    same = _digest(role, text)
                    if same in seen:
                        fault = "duplicate"
                    seen.add(same)
                if edge:
                    at += 1
                    out.rows.append((conv, part, at, None, turn, role, None, text, fault, times))
                else:
                    run.append((turn, role, text, fault, times))
                yield from out.full()
        out.rows += [(conv, part, i, None, turn, role, None, text, fault, times) for i, (turn, role, text, fault, times) in enumerate(run, 1)]
        yield from out.full(1)

    return work


def _runs(batches) -> Iterator[tuple]:
    """(conv, part, place, turn, role, text, fault, times, start, goal, tail) of sorted edge rows, one list for each segment."""
    held, key = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:2] != key:
                yield key, held
                held = []
            key = row[:2]
            held.append(row[2:])
    if held:
        yield key, held


def _segment_costs(schema: pa.Schema):
    def work(batches):
        own, out = editor(), _Writer(schema)
        for (conv, part), rows in _runs(batches):
            kinds = _kinds([r[1:6] for r in rows])
            for start in range(len(own.stacks.nodes)):
                frontier, total, _ = own.run(start, kinds)
                out.rows += [(conv, part, start, goal, total + cost, rank) for rank, (goal, cost) in enumerate(frontier)]
            yield from out.full()
        yield from out.full(1)

    return work


def _chain(costs: pd.DataFrame) -> pd.DataFrame:
    """Start and goal of every segment of one conversation, and the insertions at its end."""
    own = editor()
    frontier, back, parts = [(0, 0)], [], []
    for part, segment in costs.sort_values(["part", "start", "rank"]).groupby("part", sort=True):
        ways: dict[int, list] = {}
        for start, goal, cost, rank in zip(segment["start"], segment["goal"], segment["cost"], segment["rank"]):
            ways.setdefault(int(start), []).append((int(goal), int(cost), int(rank)))
        best: dict[int, tuple] = {}
        for place, (node, cost) in enumerate(frontier):
            for goal, more, rank in ways[node]:
                way = (cost + more, place, rank)
                if goal not in best or way < best[goal]:
                    best[goal] = way
        order = sorted(best.items(), key=lambda x: x[1][1:])
        parts.append(part)
        back.append([(frontier[w[1]][0], w[1]) for _, w in order])
        frontier = [(goal, w[0]) for goal, w in order]
    place, _, tail = own.end(tuple(frontier))
    goal, out = frontier[place][0], []
    for part, ways in zip(reversed(parts), reversed(back)):
        start, place = ways[place]
        out.append((part, start, goal, "".join(role[0] for _, role in tail) if part == parts[-1] else ""))
        goal = start
    made = pd.DataFrame(out, columns=["part", "start", "goal", "tail"])
    made.insert(0, "conv", costs["conv"].iloc[0] if len(costs) else None)
    return made


def _second_pass(schema: pa.Schema):
    def work(batches):
        own, out = editor(), _Writer(schema)
        for (conv, part), rows in _runs(batches):
            start, goal, tail = rows[0][6:9]
            run = [r[1:6] for r in rows]
            frontier, _, back = own.run(start, _kinds(run))
            place = [node for node, _ in frontier].index(goal)
            out.rows += _report(conv, part, run, own.trace(back, place), tuple(("I", ROLE_OF[t]) for t in tail))
            yield from out.full()
        yield from out.full(1)

    return work


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The cheapest edits of every conversation, one row each: conv, part and place (their order), action (keep, rerole,
    delete, insert), the row's turn, role and text, its role after the repair, its fault, and a multiplicity
    (`times`, above 1 for deleted copies only).  An empty table has no edits."""
    spark = turns.sparkSession
    ship(spark)
    one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), one_space(role).alias("role"), one_space(text).alias("text"))
    kind = rows.schema["conv"].dataType.simpleString()
    grouped = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("times"))
    order: list[Column] = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 32), F.xxhash64("text")]
    ranged = grouped.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = EDITS.format(kind=kind)
    first = staged(ranged.select("conv", "turn", "role", "text", "times").mapInArrow(_first_pass(_arrow(schema)), schema), "edits")

    edges = first.where("action is null").select("conv", "part", "place", "turn", "role", "text", "fault", "times")
    # a row that its segment has first may still be in an earlier segment: one row at most for each segment and text
    alone = (F.col("fault") == "truncated") | F.col("fault").isNull()
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    known = edges.where(alone).select("conv", same.alias("same"), "part").groupBy("conv", "same").agg(
        F.min("part").alias("least"), F.count("*").alias("many")).where("many > 1").drop("many")
    own = edges.where(alone).withColumn("same", same).alias("e")
    met = own.join(known.alias("k"), F.col("e.conv").eqNullSafe(F.col("k.conv")) & (F.col("e.same") == F.col("k.same")), "left")
    met = met.select(
        "e.conv", "part", "place", "turn", "role", "text",
        F.when(F.col("least") < F.col("part"), F.lit("duplicate")).otherwise(F.col("fault")).alias("fault"), "times")
    edges = staged(met.union(edges.where(~alone)), "edge-rows")

    dealt = lambda df: df.repartition("conv", "part").sortWithinPartitions("conv", "part", "place")
    cost_schema = f"conv {kind}, part int, start int, goal int, cost bigint, rank int"
    costs = dealt(edges).mapInArrow(_segment_costs(_arrow(cost_schema)), cost_schema)
    chain = costs.groupBy("conv").applyInPandas(_chain, f"conv {kind}, part int, start int, goal int, tail string").alias("c")
    with_ends = edges.alias("e").join(chain, F.col("e.conv").eqNullSafe(F.col("c.conv")) & (F.col("e.part") == F.col("c.part"))).select(
        "e.*", "start", "goal", "tail")
    again = dealt(with_ends).mapInArrow(_second_pass(_arrow(schema)), schema)
    return first.where("action is not null").union(again)


REPORT = "conv {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}


def summaries(edits: DataFrame) -> DataFrame:
    """One row for each conversation of `repair`'s result: gaps in its turns, faults, neighbours whose roles don't
    follow each other, the edits' cost and initials, and the SHA-256 of the repaired `role:text` lines.  A conversation's edits
    pass through one task in order, which keeps nothing of them but the audit."""
    kind = edits.schema["conv"].dataType.simpleString()
    schema = REPORT.format(kind=kind)
    target = _arrow(schema)

    def work(batches):
        out, conv, state = _Writer(target), None, None

        def closed():
            n, turns, lowest, highest, faults, illegal, cost, audit, digest = state[:9]
            gaps = 0 if lowest is None else highest - lowest + 1 - turns
            return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, "".join(audit), digest.hexdigest())

        for batch in batches:
            for key, action, turn, role, new_role, text, fault, times in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or key != conv:
                    if state:
                        out.rows.append(closed())
                        yield from out.full()
                    conv, before = key, None
                    state = [0, 0, None, None, dict.fromkeys(KIND, 0), 0, 0, [], hashlib.sha256(), 0]
                letter = action[0].upper()
                state[7].append(letter * times)
                if letter != "I":
                    if turn is not None:
                        state[2] = turn if state[2] is None else state[2]
                        state[1] += state[3] != turn
                        state[3] = turn
                    state[4][fault] += times
                    own = initial_of(role)
                    state[5] += (before is not None and before + own not in LEGAL) + (times - 1)
                    before = own
                state[6] += {"I": INSERT, "D": DELETE * times, "R": RETURN, "K": 0}[letter]
                if letter != "D":
                    state[6] += TRUNCATED if fault == "truncated" else 0
                    line = f"{new_role}:{text}".encode("utf-8", "surrogatepass")
                    state[8].update(b"\n" + line if state[9] else line)
                    state[9] += 1
        if state:
            out.rows.append(closed())
        yield from out.full(1)

    rows = edits.repartition("conv").sortWithinPartitions("conv", "part", "place")
    return rows.select("conv", "action", "turn", "role", "repaired_role", "text", "fault", "times").mapInArrow(work, schema)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with reproducible damage: by the crc32 of `conv:turn` modulo 20 a row is dropped (0), loses its
    text (1) or its sentence ends (2), is repeated (3) or becomes the user's (4).  Nulls count as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")) % 20
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), draw.alias("draw"))
    return rows.where("draw != 0").select(
        "conv", "turn", F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
