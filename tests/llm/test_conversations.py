"""Conversation repair against brute force: all edit sequences of short conversations, and a plain program over table rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tradewind.llm import conversation_repair as cr
from tradewind.llm import queries

SF = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def faults_of(rows):
    """rows: (role, text)"""
    seen, out = set(), []
    for role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_way(rows, faults):
    """All edit sequences with up to three insertions in a row: (cost, audit, repaired)."""
    inserts = [tuple(x) for n in range(4) for x in itertools.product(["user", "assistant"], repeat=n)]

    def walk(i):
        for extra in inserts:
            pre = (5 * len(extra), "I" * len(extra), [(r, "") for r in extra])
            if i == len(rows):
                yield pre
                continue
            role, text = rows[i]
            choices = [(2, "D", [])]
            if faults[i] not in ("blank", "duplicate"):
                cost = 5 if faults[i] == "truncated" else 0
                choices += [(cost, "K", [(role, text)]), (cost + 1, "R", [("user", text)]), (cost + 1, "R", [("assistant", text)])]
            for c, letter, kept in choices:
                for cost, audit, rest in walk(i + 1):
                    yield pre[0] + c + cost, pre[1] + letter + audit, pre[2] + kept + rest

    return walk(0)


def test_editor_finds_the_cheapest_of_all_ways():
    rng = random.Random(5)
    own = cr.Editor()
    cases = [[]] + [
        [(rng.choice(["user", "assistant", "system", "tool", " ", ""]), rng.choice(["a.", "b!", "c", "", "d?"])) for _ in range(rng.choice([1, 2, 2]))]
        for _ in range(60)]
    for rows in cases:
        faults = faults_of(rows)
        legal = (w for w in every_way(rows, faults) if LEGAL.match("".join(r[:1] or "?" for r, _ in w[2])))
        cost, audit, repaired = min(legal, key=lambda w: w[:2])
        kinds = [(cr.initial_of(r), cr.KIND[f], 1) for (r, _), f in zip(rows, faults)]
        frontier, total, back = own.run(0, kinds)
        place, more, tail = own.end(frontier)
        edits = [e for row in own.trace(back, place) for e in row] + list(tail)
        assert (total + more, "".join(e[0] for e in edits)) == (cost, audit), rows
        texts = iter(rows)
        made = []
        for letter, role in edits:
            old = ("", "") if letter == "I" else next(texts)
            if letter != "D":
                made.append((role or old[0], old[1]))
        assert made == repaired


def plain_costs(rows, faults):
    """Cheapest (cost, audit, repaired) by a table over (row, state), the states being those of a four-state automaton."""
    after = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, kept) in list(table.items()):
                for t in "ua":
                    to = after.get((state, t))
                    way = (cost + 5, audit + "I", kept + [(name[t], "")])
                    if to and (to not in table or way[:2] < table[to][:2]):
                        table[to] = way
        return table

    table = {"0": (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        new: dict = {}

        def offer(to, way):
            if to not in new or way[:2] < new[to][:2]:
                new[to] = way

        for state, (cost, audit, kept) in table.items():
            offer(state, (cost + 2, audit + "D", kept))
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            for state, (cost, audit, kept) in inserted(dict(table)).items():
                if (state, role[:1]) in after:
                    offer(after[state, role[:1]], (cost + extra, audit + "K", kept + [(role, text)]))
                for t in "ua":
                    if (state, t) in after:
                        offer(after[state, t], (cost + extra + 1, audit + "R", kept + [(name[t], text)]))
        table = new
    return min((w for s, w in inserted(dict(table)).items() if s in "0a"), key=lambda w: w[:2])


def plain(rows):
    """Expected report of every conversation of (conv, turn, role, text) rows."""
    ids, by = [], {}
    for conv, turn, role, text in rows:
        ids.append(conv)
        spaced = lambda x: " " if x is None else str(x)
        draw = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        by.setdefault(conv, []).extend([(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1))
    out = {}
    for conv in set(ids):
        own = sorted(by.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in own} - {None}
        said = [r[1:] for r in own]
        faults = faults_of(said)
        cost, audit, repaired = plain_costs(said, faults)
        initials = [r[:1] for r, _ in said]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def report(turns):
    return {r[0]: tuple(r)[1:] for r in queries.repaired_conversations(turns).collect()}


@pytest.mark.parametrize("partitions", [1, 5])
def test_query_equals_plain_program(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.read.parquet(f"{SF}/conversations.parquet")
        assert report(turns) == plain([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_awkward_rows_and_one_hot_conversation(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No!", "half", "", "said"]) + str(rng.randrange(60)) + rng.choice([".", ""]))
            for t in range(900)]
    rows += [(c, t if rng.random() < 0.8 else None, rng.choice(["user", "assistant", "tool", None, "", "system"]), rng.choice(["a.", "b", None, " \t", "ü?", "x" * 3000]))
             for c in (2, 3, None, 5) for t in [rng.randrange(6) for _ in range(9)]]
    rows += [(7, None, "user", "hi.")] * 5 + [(8, 0, None, None)] * 4 + [(c, 0, "user", "?") for c in range(9, 60)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", "1 as part", "2 as place", "'x' as conv", "'k' as fault", "0 as times")
    spark.conf.set("spark.sql.shuffle.partitions", 6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = cr.repair(table)
        assert edits.where("conv = 1").select("part").distinct().count() > 2  # one conversation over several tasks
        assert report(table) == plain(rows)
        nothing = table.where("false")
        assert cr.repair(nothing).count() == 0 and report(nothing) == {}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
