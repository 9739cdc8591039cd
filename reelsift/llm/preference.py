"""Chat formatting of preference pairs.

A pair is two conversations, chosen and rejected.  Their longest common prefix of turns is rendered once, as prompt; what follows
it on either side is a completion.  Each turn is rendered as header, text and end mark; the loss mask covers text and end mark of the assistant's
turns in completions, and nothing of the prompt.

Rows of both sides are one table in which a bit mask tells the sides that have a row, so equal rows meet in one aggregation, which also drops repeated ones before they are shuffled.  What is
left is dealt once by pair and stretch of turns (``PART_TURNS``): all else, the first difference in a stretch and the rendering, happens where the rows
are.  So a conversation of any length is spread over tasks, and rendered text comes in parts; ordinary conversations have one.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, few

PART_TURNS = 256


def rendered(role: Column, text: Column) -> tuple[Column, Column]:
    """(header, rest) of a turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n")), F.concat(text, F.lit("<|end|>\n"))


CHOSEN, REJECTED = 1, 2


def both_sides(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair, turn, role, text, sides) of pairs given as rows (pair, turn, role, text) of either side."""
    names = ["pair", "turn", "role", "text"]
    return chosen.select(*names, F.lit(CHOSEN).alias("sides")).unionByName(rejected.select(*names, F.lit(REJECTED).alias("sides")))


def preference_rows(marked: DataFrame, *, part_turns: int = PART_TURNS) -> DataFrame:
    """(pair, side, part, turn, role, text, trained) of rows (pair, turn, role, text, sides): side is "prompt", "chosen" or "rejected".

    sides: 1 for a row of the chosen conversation, 2 of the rejected one, 3 of both.  Null roles count as "user", null texts as empty; rows with a null pair or turn belong to no place and are left out.  Repeated rows
    count once.  Turns of one number are one place: it is common where both sides have the same set of rows there.  A side may be
    missing; then all of the other is completion.  Other columns are left out; an empty table gives an empty one.
    """
    part = F.floor(F.col("turn") / part_turns).cast("long").alias("part")
    clean = marked.where("pair is not null and turn is not null").select("pair", part, "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "sides")
    rows = clean.groupBy("pair", "part", "turn", "role", "text").agg(F.bit_or("sides").alias("sides")).repartition("pair", "part")
    parts = rows.groupBy("pair", "part").agg(F.min(F.when(F.col("sides") < CHOSEN + REJECTED, F.col("turn"))).alias("differs"))
    firsts = parts.groupBy("pair").agg(F.min("differs").alias("first"))
    told = rows.join(parts.select("pair", "part").join(firsts, "pair"), ["pair", "part"])
    common = F.coalesce(F.col("turn") < F.col("first"), F.lit(True))
    on = lambda bit, name: F.when(F.col("sides").bitwiseAND(F.lit(bit)) > 0, name)
    side = F.when(common, F.array(F.lit("prompt"))).otherwise(F.array_compact(F.array(on(CHOSEN, "chosen"), on(REJECTED, "rejected"))))
    return told.select("pair", "part", "turn", "role", "text", (~common & (F.col("role") == "assistant")).alias("trained"), F.explode(side).alias("side"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, *, part_turns: int = PART_TURNS) -> DataFrame:
    """:func:`format_marked` of two conversations a pair, given as rows (pair, turn, role, text)."""
    return format_marked(both_sides(chosen, rejected), part_turns=part_turns)


def format_marked(marked: DataFrame, *, part_turns: int = PART_TURNS) -> DataFrame:
    """(pair, side, part, n_turns, text, trained_spans): rendered prompts and completions of :func:`preference_rows`' input.

    trained_spans: (start, end) of the trained characters in the part's text, as structs.  Parts are numbered from the
    turn number divided by ``part_turns``; a side's text is its parts' in order.  A pair with an empty side has no row for it.
    """
    rows = preference_rows(marked, part_turns=part_turns)
    header, rest = rendered(F.col("role"), F.col("text"))
    turns = rows.select("pair", "side", "part", F.struct("turn", "role", header.alias("header"), rest.alias("rest"), "trained").alias("x"))
    parts = turns.groupBy("pair", "side", "part").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    size = lambda x: F.char_length(x["header"]) + F.char_length(x["rest"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate(
        "xs",
        start,
        lambda acc, x: F.struct(
            (acc["at"] + size(x)).alias("at"),
            F.when(x["trained"], F.array_append(acc["spans"], F.struct((acc["at"] + F.char_length(x["header"])).alias("start"), (acc["at"] + size(x)).alias("end")))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("xs", lambda x: F.concat(x["header"], x["rest"])), "")
    return parts.select("pair", "side", "part", F.size("xs").cast("long").alias("n_turns"), text.alias("text"), spans.alias("trained_spans"))


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """(pair, turn, role, text, sides) rows made from conversations (conv_id, turn, role, text).

    Chosen: each conversation.  Rejected: its turns before its last one, and at that place the last turn of the conversation whose id differs in
    the lowest bit, with its role and text; where there is none, nothing.
    """
    rows = conversations.select(F.col("conv_id").alias("pair"), "turn", "role", "text").where("pair is not null and turn is not null")
    # one row for each conversation and task before it is shuffled
    last = checkpoint(rows.groupBy("pair").agg(F.max(F.struct("turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("x")).select("pair", F.col("x.turn").alias("last"), F.col("x.role").alias("role"), F.col("x.text").alias("text")))
    marked = rows.join(few(last.select("pair", "last")), "pair").select("pair", "turn", "role", "text", F.when(F.col("turn") < F.col("last"), CHOSEN + REJECTED).otherwise(CHOSEN).alias("sides"))
    other = last.select(F.col("pair").bitwiseXOR(F.lit(1).cast("long")).alias("pair"), "role", "text")
    reply = last.select("pair", F.col("last").alias("turn")).join(other, "pair").select("pair", "turn", "role", "text", F.lit(REJECTED).alias("sides"))
    return marked.unionByName(reply)
