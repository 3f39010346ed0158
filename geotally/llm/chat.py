"""Chat formatting from event logs: fold the events of each turn into its final message, render, and read back.

A turn is rendered as ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and texts get a star after their
first character (and those that have stars one more), so that splitting at control strings is always safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\**/?(?:s>|INST\]))", "$1*$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\*(\**/?(?:s>|INST\]))", "$1$2")


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after all events (conv_id, seq, kind, turn, role, text), by native windows.

    ``message`` and ``edit`` set the text of their turn, ``delta`` adds to it, ``regenerate`` drops the turn and all
    later ones as they were before it. A turn has the newest role named for it (else an empty one), and none of its
    events left means no turn. Events with equal seq are applied in order of kind and text, each as it would be alone: of
    two that set a text the later one holds, a delta before one that sets is overwritten, and a regenerate comes last. A
    repeated delta is added as often as it is there. Null texts are empty; null ids and turns are ids and turns like others, nulls first.
    """
    e = events.select(
        "conv_id", "seq", "kind", "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    turn = Window.partitionBy("conv_id", "turn")
    e = e.withColumn("cut", F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier))
    e = e.withColumn("set", F.max(F.when(F.col("kind").isin("message", "edit"), F.col("seq"))).over(turn))
    e = e.withColumn("named", F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "kind", "text", "role"))).over(turn))
    after = F.col("cut").isNull() | (F.col("seq") > F.col("cut"))
    live = e.where((F.col("kind") != "regenerate") & after & (F.col("seq") >= F.coalesce("set", "seq")))
    events = live.groupBy("conv_id", "turn").agg(
        F.first("named").alias("named"), F.sort_array(F.collect_list(F.struct("seq", "kind", "text"))).alias("parts")
    )
    sets = events.withColumn("held", F.array_max(F.filter("parts", lambda p: p["kind"] != "delta")))
    added = F.filter("parts", lambda p: (p["kind"] == "delta") & F.coalesce(p > F.col("held"), F.lit(True)))
    text = F.concat(F.coalesce("held.text", F.lit("")), F.array_join(F.transform(added, lambda p: p["text"]), ""))
    return sets.select("conv_id", "turn", F.coalesce("named", F.lit("")).alias("role"), text.alias("text"))


def formatted(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the rendered conversation, and the (start, length) in code points of what is learned.

    The loss mask lies on the texts of role ``assistant`` and on nothing else.
    """
    order = Window.partitionBy("conv_id").orderBy("turn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY))
    m = messages.select("conv_id", "turn", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    m = m.withColumn("piece", F.concat("head", "body", F.lit(END + CLOSE)))
    m = m.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
    pieces = F.sort_array(F.collect_list(F.struct("turn", "piece", "at", F.length("body").alias("size"), (F.col("role") == "assistant").alias("learned"))))
    return m.groupBy("conv_id").agg(pieces.alias("pieces")).select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(F.filter("pieces", lambda p: p["learned"]), lambda p: F.struct(p["at"].alias("start"), p["size"].alias("length"))).alias("loss"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, learned) out of rendered conversations: an array of (role, text), and the text under the mask."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(TURN) + 1)), BODY, 1)
        before = F.length(role) + len(TURN) + len(BODY)
        text = F.substr(piece, before + 1, F.length(piece) - before - len(END))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    pieces = F.filter(F.split("formatted", r"</s>"), lambda p: p != "")
    learned = F.transform("loss", lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), F.array_join(learned, "").alias("learned"))


def chats_from_events(events: DataFrame) -> DataFrame:
    """Event log to rendered conversations with their loss mask; an empty log gives no rows."""
    return formatted(final_messages(events))


def events_of_rows(rows: DataFrame) -> DataFrame:
    """The log of a table (conv_id, turn, role, text) of finished turns: a message each, and for assistants the text as a delta.

    Rows are numbered by turn; ties go by role, then text, and repeated rows are turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    r = rows.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order).cast("long"))
    streamed = F.col("role").eqNullSafe("assistant")

    def event(seq: Column, kind: str, text: Column) -> Column:
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    start = event(2 * F.col("n"), "message", F.when(~streamed, F.col("text")))
    more = event(2 * F.col("n") + 1, "delta", F.col("text"))
    log = F.when(streamed, F.array(start, more)).otherwise(F.array(start))
    return r.withColumn("e", F.explode(log)).select("conv_id", "e.seq", "e.kind", F.col("n").alias("turn"), "role", "e.text")
