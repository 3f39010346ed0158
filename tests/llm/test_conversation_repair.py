"""Conversation repair against a search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from geotally.llm import conversation_repair as cr
from geotally.llm.common import table
from geotally.llm.queries import op13_conversation_repair
from tests.conftest import DATA

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        out += [(conv, turn, "user" if way == 4 else role, text)] * {0: 0, 3: 2}.get(way, 1)
    return out


def brute_conversation(rows):
    """Of (turn, role, text) in any order: all numbers of the report, by a search over every edit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        end = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(t, state, inserted=0):
        """(cost, audit, turns) of the best way on, after ``inserted`` turns since row t - 1: four at most."""
        ways = [(0, "", ())] if t == len(rows) and state in ("", "a") else []

        def add(cost, letter, kept, *onward):
            rest = best(*onward)
            if rest:
                ways.append((cost + rest[0], letter + rest[1], kept + rest[2]))

        for role in ("user", "assistant"):
            if inserted < 4 and (state, role[0]) in after:
                add(2, "I", ((role, ""),), t, after[state, role[0]], inserted + 1)
        if t < len(rows):
            _, role, text = rows[t]
            add(3, "D", (), t + 1, state)
            if faults[t] not in ("b", "d"):
                for cost, letter, kept in [(0, "K", role), (2, "R", "user"), (2, "R", "assistant")]:
                    if (state, kept[:1]) in after:
                        add(cost + (faults[t] == "t"), letter, ((kept, text),), t + 1, after[state, kept[:1]])
        return min(ways, key=lambda w: w[:2]) if ways else None

    for t in range(len(rows), 0, -1):  # from the end, so that the search does not call itself too deep
        for state in ("", "s", "u", "a"):
            best(t, state)
    cost, audit, said = best(0, "")
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in said).encode()).hexdigest(),
    )


def brute(rows):
    by = {conv: [] for conv, *_ in rows}
    for conv, *rest in brute_damage(rows):
        by[conv].append(tuple(rest))
    return {conv: brute_conversation(tuple(r)) for conv, r in by.items()}


def shown(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_given_conversations_match_a_search(spark):
    rows = [tuple(r) for r in table(spark, str(DATA), "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversation_repair(spark, str(DATA))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert shown(got) == brute(rows)


@pytest.mark.parametrize("block", [1024, 3])
def test_hard_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    rng = random.Random(5)
    rows = [(None, None, None, None), (None, 3, "user", "x."), (1, None, "user", "a."), (1, None, "assistant", "b."), (2, 5, "", "c."), (3, 0, "tool", "d.")]
    rows += [(4, 0, "system", "only."), (5, -3, "assistant", "a"), (5, 9, "assistant", "a"), (6, 1, "user", "same."), (6, 1, "user", "same."), (6, 1, "user", "same.")]
    for conv in range(10, 130):
        for _ in range(rng.randrange(1, 14)):
            text = rng.choice(["", " \t", "hm", "yes.", "no!", "why?  ", "a\nb.", "ä", "end.\r\n"]) + rng.choice(["", "", "tail."])
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), text))
    got = cr.repair_report(cr.damaged(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(rows, SCHEMA))
    assert shown(got) == brute(rows)


def test_a_conversation_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK", 64)
    rows = [(7, k, ("user", "user", "assistant", "system")[k % 4], f"{k % 150}." if k % 7 else "cut") for k in range(700)]
    got = cr.repair_report(spark.createDataFrame(rows, SCHEMA))
    assert shown(got)[7] == brute_conversation(tuple(r[1:] for r in rows))


def test_empty_table_and_more_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(cr.damaged(none), none).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], SCHEMA)
    more = rows.select("*", F.lit(1).alias("block"), F.lit("x").alias("audit"), F.lit(2).alias("codes"), F.lit(3).alias("blank"))
    assert shown(cr.repair_report(more)) == shown(cr.repair_report(rows))
    one = cr.repaired(more).first()
    assert one.audit == "KK" and [tuple(t) for t in one.turns] == [("user", "a."), ("assistant", "b.")]
