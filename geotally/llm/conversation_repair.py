"""Conversation structure repair: a cost DP over the rows, then the least audit among the cheapest by prefix-doubling path ranking.

A conversation is cut into blocks of ``BLOCK`` rows in the order of its turns, so that one of any length is worked on by many
tasks. A block is a min-plus matrix over the four states of the pattern ``(s?(ua)+)?``; chained from the end they give the costs
to go at each border. Within a block, the nodes are (rows done, state), the arcs that lie on a cheapest way are labelled with the
initial of their edit, and pointers and ranks are doubled: ranks of audits of 2, 4, 8 … letters come from those of half the length,
and the least path is read off through the doubled pointers, all its steps at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from geotally.llm.common import BLANKS, written

#: Rows of a block at most, and blocks that are worked on at once (in rows).
BLOCK, ROWS_AT_ONCE = 1024, 50_000
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn. A turn that is not the system's
#: leads to the next of these.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
LETTERS = np.array(["", "D", "I", "K", "R"])
FAR = 1 << 28
ROLE = {USER: "user", ASSISTANT: "assistant"}

ORDER = ("turn", "role", "text")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults that a hash of conversation and turn chooses; null roles and texts are one space."""

    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    way = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(way == 1, "").when(way == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    copies = F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        rows.where(way != 0)
        .select("conv_id", "turn", F.when(way == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), copies.alias("_copy"))
        .drop("_copy")
    )


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``blank``, ``ends`` (not truncated) and ``late`` (role and text were there in an earlier turn)."""
    bare = F.rtrim("text", F.lit(BLANKS))
    marked = rows.select(
        "conv_id", "turn", "role", "text", (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ends"),
        F.xxhash64("conv_id", "role", "text").alias("_said"),
    )
    # Only what several turns say is looked up; the hash is a filter, and the join compares the whole.
    turn = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    said = marked.groupBy("_said", "conv_id", "role", "text").agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
    again = said.where("NOT first <=> last").select("_said", *(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")), "first")
    same = (marked["_said"] == again["_said"]) & marked["conv_id"].eqNullSafe(F.col("_conv_id"))
    same &= (marked["role"] == F.col("_role")) & (marked["text"] == F.col("_text"))
    late = F.col("first").isNotNull() & ~turn.eqNullSafe(F.col("first"))
    return marked.join(again, same, "left").select("conv_id", "turn", "role", "text", "blank", "ends", late.alias("late"))


def _cut(kind) -> StructType:
    texts, whole = ArrayType(StringType()), LongType()
    fields = [("conv_id", kind), ("roles", texts), ("texts", texts), ("codes", ArrayType(IntegerType()))]
    fields += [(c, whole) for c in ("n_blank", "n_duplicate", "n_truncated", "illegal", "n_turns", "first_turn", "last_turn")]
    return StructType([StructField(n, t) for n, t in [*fields, ("first_initial", StringType()), ("last_initial", StringType())]])


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the ``rows`` (conv_id, turn, role, text) of conversations, in the order of ``block`` within each.

    Rows are sorted by conversation, turn (nulls first), role and text over all partitions; a range may end within a conversation.
    ``codes`` hold the role (a state, or 0), 4 if the row must go and 8 if it is truncated.
    """
    key = [F.col("conv_id").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in ORDER)]
    ordered = _faults(rows).repartitionByRange(*key).sortWithinPartitions(*key)
    ordered = ordered.withColumn("no_conv", F.col("conv_id").isNull()).withColumn("no_turn", F.col("turn").isNull())
    role_of = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

    def block_of(conv, held: list) -> tuple:
        turns = [r[1] for r in held if r[1] is not None]
        initials = [r[2][:1] for r in held]
        codes = [role_of.get(i, 0) | 4 * (r[4] > 0) | 8 * (r[4] == 0 and not r[5]) for i, r in zip(initials, held, strict=True)]
        wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        faults = [sum(r[4] == 1 for r in held), sum(r[4] == 2 for r in held), sum(c & 8 > 0 for c in codes)]
        edges = [len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None, initials[0], initials[-1]]
        return (conv, [r[2] for r in held], [r[3] for r in held], codes, *faults, wrong, *edges)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, conv, before, done = [], None, None, []
        names = _cut(StringType()).names

        def frame():
            out = pd.DataFrame(done, columns=names)
            for c in names[4:11]:
                out[c] = out[c].astype("Int64")
            return out

        for b in batches:
            for r in b.itertuples(index=False):
                own = None if r.no_conv else r.conv_id
                turn = None if r.no_turn else int(r.turn)
                if held and (own != conv or len(held) == BLOCK):
                    done.append(block_of(conv, held))
                    held = []
                conv = own
                now = (own, turn, r.role, r.text)
                held.append((*now, 1 if r.blank else 2 if r.late or now == before else 0, r.ends))
                before = now
            if len(done) >= 200:
                yield frame()
                done = []
        if held:
            done.append(block_of(conv, held))
        yield frame()

    kind = rows.schema["conv_id"].dataType
    shown = ordered.withColumn("conv_id", F.col("conv_id").cast("string")).withColumn("turn", F.coalesce(F.col("turn").cast("long"), F.lit(0)))
    made = shown.mapInPandas(each, _cut(StringType())).withColumn("conv_id", F.col("conv_id").cast(kind))
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


def _padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(c) for c in codes])
    out = np.zeros((len(codes), sizes.max()), np.int64)
    for row, c in zip(out, codes, strict=True):
        row[: len(c)] = c
    return out, sizes


def costs_to_go(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(block, rows done, state): the least cost of the rest of each block, given that at its end (block, state)."""
    n, width = codes.shape
    cost = np.empty((n, width + 1, 4), np.int64)
    cost[:, width] = ends
    states = np.arange(4)
    for t in range(width - 1, -1, -1):
        after, code = cost[:, t + 1], codes[:, t]
        now = after + DELETE
        stays, cut = (code & 4) == 0, np.where(code & 8, TRUNCATED, 0)
        now = np.where(stays[:, None], np.minimum(now, after[:, NEXT] + REROLE + cut[:, None]), now)
        for role, froms in ((SYSTEM, [START]), (USER, [START, SYSTEM, ASSISTANT]), (ASSISTANT, [USER])):
            fits = (stays & ((code & 3) == role))[:, None] & np.isin(states, froms)
            now = np.where(fits, np.minimum(now, (after[:, role] + cut)[:, None]), now)
        now = _with_inserts(now)
        cost[:, t] = np.where((t < sizes)[:, None], now, after)
    return np.minimum(cost, FAR)


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    for _ in range(3):
        cost = np.minimum(cost, cost[..., NEXT] + INSERT)
    return cost


#: Costs to go after the last row: nothing and a whole number of pairs are complete.
AT_END = _with_inserts(np.array([0, FAR, FAR, 0]))


def _arcs(codes: np.ndarray, sizes: np.ndarray, cost: np.ndarray, last: np.ndarray) -> np.ndarray:
    """(node, letter D I K R): the node that a cheapest edit leads to, or -1. Nodes are numbered by block, rows done and state."""
    n, width = codes.shape
    node = np.arange(n * (width + 1) * 4).reshape(n, width + 1, 4)
    to = np.full((n, width + 1, 4, 4), -1)
    inside = (np.arange(width) < sizes[:, None])[..., None]
    here, after, code = cost[:, :-1], cost[:, 1:], codes[..., None]
    stays, cut = (code & 4) == 0, np.where(code & 8, TRUNCATED, 0)
    to[:, :-1, :, 0] = np.where(inside & (here == after + DELETE), node[:, 1:], -1)
    open_ = np.arange(width + 1) < (sizes + last)[:, None]
    to[..., 1] = np.where(open_[..., None] & (cost == cost[..., NEXT] + INSERT) & (cost < FAR), node[..., NEXT], -1)
    to[:, :-1, :, 3] = np.where(inside & stays & (here == after[..., NEXT] + REROLE + cut), node[:, 1:][..., NEXT], -1)
    for role, froms in ((SYSTEM, [START]), (USER, [START, SYSTEM, ASSISTANT]), (ASSISTANT, [USER])):
        for state in froms:
            fits = inside[..., 0] & stays[..., 0] & ((codes & 3) == role) & (here[..., state] == after[..., role] + cut[..., 0])
            to[:, :-1, state, 2] = np.where(fits, node[:, 1:, role], to[:, :-1, state, 2])
    return to.reshape(-1, 4)


def least_paths(to: np.ndarray, entries: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(letters, end) of the least path from each of ``entries``: letters are 1 to 4, then 0 after its end.

    ``to`` has each node's targets by letter, -1 where there is none. The rank of a node among all by its least audit of
    2 L letters is that of its pair (rank by L letters, rank by L letters of the node that these lead to). No two arcs of a
    node have the same letter, so the letters read settle the node reached.
    """
    own = np.arange(len(to))
    known = to >= 0
    letter = np.where(known.any(axis=1), known.argmax(axis=1) + 1, 0)
    pointer = np.where(letter > 0, to[own, np.maximum(letter - 1, 0)], own)
    pointers, rank, reach = [pointer], letter, 1
    while reach < longest:
        far = pointers[-1]
        pairs = rank.astype(np.int64) * (rank.max() + 1) + rank[far]
        rank = np.unique(pairs, return_inverse=True)[1]
        pointers.append(far[far])
        reach *= 2
    # Of a node's arcs the one whose letter and rest rank least begins its path.
    rest = np.where(known, rank[np.maximum(to, 0)], 0) + np.arange(4) * (rank.max() + 1)
    best = np.where(known, rest, np.iinfo(np.int64).max).argmin(axis=1)
    letter = np.where(letter > 0, best + 1, 0)
    step = np.arange(longest)
    at = np.repeat(entries[:, None], longest, axis=1)
    for j, hop in enumerate(pointers):
        at = np.where((step >> j) & 1, hop[at], at)
    return letter[at], pointers[-1][at[:, -1]]


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of blocks of like length that hold ``ROWS_AT_ONCE`` padded rows at most (one block at least)."""
    for b in frames:
        if len(b):
            b = b.assign(_n=[len(c) for c in b["codes"]]).sort_values("_n", kind="stable")
            first = 0
            for k in range(1, len(b) + 1):
                if k == len(b) or (k + 1 - first) * b["_n"].iloc[k] > ROWS_AT_ONCE:
                    yield b.iloc[first:k]
                    first = k


def _matrices(cut: DataFrame) -> DataFrame:
    """(block, matrix): least cost through a block by entry and exit state, row by row in one array."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _batches(frames):
            codes, sizes = _padded(list(b["codes"]))
            exits = np.where(np.eye(4, dtype=bool), 0, FAR)
            through = [costs_to_go(codes, sizes, np.broadcast_to(e, (len(b), 4)))[:, 0] for e in exits]
            yield pd.DataFrame({"block": b["block"], "matrix": list(np.stack(through, axis=2).reshape(len(b), 16))})

    return cut.select("block", "codes").mapInPandas(each, "block long, matrix array<long>")


def _borders(cut: DataFrame) -> DataFrame:
    """One row per conversation: its counts, its cost, and (block, costs at the end, is last) of its blocks."""
    small = cut.drop("roles", "texts", "codes").join(_matrices(cut), "block")
    edges = F.struct("block", "matrix", *(c for c in small.columns if c not in ("block", "matrix", "conv_id")))
    lists = small.groupBy("conv_id").agg(F.sort_array(F.collect_list(edges)).alias("edges"))
    kind = cut.schema["conv_id"].dataType

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in frames:
            out = []
            for conv, edges in zip(b["conv_id"], b["edges"], strict=True):
                cost, ends = AT_END, []
                for e in reversed(edges):
                    ends.append((e["block"], [int(x) for x in cost], not ends))
                    cost = np.minimum((np.array(e["matrix"]).reshape(4, 4) + cost).min(axis=1), FAR)
                turns = [(e["first_turn"], e["last_turn"], e["n_turns"]) for e in edges if e["n_turns"]]
                shared = sum(a[1] == z[0] for a, z in zip(turns, turns[1:], strict=False))
                gaps = turns[-1][1] - turns[0][0] + 1 - sum(n for *_, n in turns) + shared if turns else 0
                joints = [(a["last_initial"] + z["first_initial"]) for a, z in zip(edges, edges[1:], strict=False)]
                illegal = sum(e["illegal"] for e in edges) + sum(j not in ("su", "ua", "au") for j in joints)
                sums = [sum(e[c] for e in edges) for c in ("n_blank", "n_duplicate", "n_truncated")]
                out.append((conv, int(gaps), *map(int, sums), int(illegal), int(cost[START]), ends))
            yield pd.DataFrame(out, columns=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "ends"])

    ends = "array<struct<block:long,costs:array<long>,is_last:boolean>>"
    shown = lists.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(
        each, f"conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, ends {ends}"
    )
    return shown.withColumn("conv_id", F.col("conv_id").cast(kind))


def _audits(cut: DataFrame, ends: DataFrame) -> DataFrame:
    """(block, exits, audits) by entry state of each block: the state at its end and the least of its cheapest audits."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _batches(frames):
            codes, sizes = _padded(list(b["codes"]))
            last = b["is_last"].to_numpy(bool).astype(int)
            cost = costs_to_go(codes, sizes, np.stack(list(b["costs"])))
            to = _arcs(codes, sizes, cost, last)
            entries = (np.arange(len(b))[:, None] * (codes.shape[1] + 1) * 4 + np.arange(4)).ravel()
            letters, end = least_paths(to, entries, 2 * codes.shape[1] + 4)
            audits = ["".join(LETTERS[x]) for x in letters]
            groups = [audits[k : k + 4] for k in range(0, len(audits), 4)]
            yield pd.DataFrame({"block": b["block"], "exits": list((end % 4).reshape(-1, 4)), "audits": groups})

    rows = cut.select("block", "codes").join(ends, "block")
    return rows.mapInPandas(each, "block long, exits array<long>, audits array<string>")


def applied(audit: str, entry: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """(role, text) of a block's rows after the edits of ``audit``, from the state ``entry``."""
    out, state, t = [], entry, 0
    for edit in audit:
        if edit == "D":
            t += 1
            continue
        if edit == "K":
            state = SYSTEM if roles[t][:1] == "s" else int(NEXT[state])
            out.append((roles[t], texts[t]))
        else:
            state = int(NEXT[state])
            out.append((ROLE[state], "" if edit == "I" else texts[t]))
        t += edit != "I"
    return out


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; other columns do not count): its faults, cost, audit and turns.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns): ``turns`` are (role, text) after the edits. Rows are
    taken by turn (nulls first), then role and text. Null roles and texts count as one space, a null conv_id as a conversation of its
    own; a role is known by its initial, so an empty role is never kept. An empty table gives no rows.
    """
    shown = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    cut = written(blocks(shown), "blocks")
    convs = written(_borders(cut), "borders")
    ends = convs.select(F.explode("ends").alias("e")).select("e.*")
    ways = _audits(cut, ends)
    owned = cut.select("block", "conv_id").join(ways, "block")
    chains = owned.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "exits", "audits"))).alias("ways"))
    # The chain of states through a conversation's blocks: each begins where the one before it ends.
    begin = F.struct(F.lit(0).cast("long").alias("state"), F.array().cast("array<struct<block:long,entry:long,audit:string>>").alias("taken"))
    chain = F.aggregate(
        "ways",
        begin,
        lambda s, w: F.struct(
            F.element_at(w["exits"], (s["state"] + 1).cast("int")).alias("state"),
            F.concat(
                s["taken"],
                F.array(
                    F.struct(
                        w["block"].alias("block"), s["state"].alias("entry"), F.element_at(w["audits"], (s["state"] + 1).cast("int")).alias("audit")
                    )
                ),
            ).alias("taken"),
        ),
        lambda s: s["taken"],
    )
    taken = chains.select(F.explode(chain).alias("t")).select("t.*")

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in frames:
            cols = (b[c] for c in ("audit", "entry", "roles", "texts"))
            done = [[{"role": r, "text": x} for r, x in applied(*row)] for row in zip(*cols, strict=True)]
            yield pd.DataFrame({"block": b["block"], "audit": b["audit"], "turns": done})

    edited = cut.select("block", "roles", "texts").join(taken, "block").mapInPandas(
        each, "block long, audit string, turns array<struct<role:string,text:string>>"
    )
    parts = cut.select("block", "conv_id").join(edited, "block").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "audit", "turns"))).alias("parts")
    )
    whole = parts.select(
        F.col("conv_id").alias("_conv"), F.array_join("parts.audit", "").alias("audit"), F.flatten("parts.turns").alias("turns")
    )
    return convs.drop("ends").join(whole, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def repair_report(rows: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """The faults, cost and audit of ``repaired`` with a digest of the repaired turns, a line ``role:text`` each.

    With ``original``, every conversation of that table is there; one without rows has zeros, an empty audit and the digest of nothing.
    """
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    found = repaired(rows).withColumn("repaired_sha256", F.sha2(line, 256)).drop("turns")
    if original is None:
        return found
    known = original.select(F.col("conv_id").alias("_known")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    joined = known.join(found, F.col("_known").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("_known").alias("conv_id"), *counts, *nothing)
