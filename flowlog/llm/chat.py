"""Preference examples from chosen and rejected conversations, in DataFrame functions only.

The turns both sides begin with are rendered once, as the prompt; what follows on each side is a
completion, with the character ranges that are trained on: the assistant's turns. Turns are compared in
order, by role and text, a null equal to a null.

Defined results: a side without turns has an empty completion. Equal sides are all prompt. Null texts
render as empty, null roles as ``unknown``. Repeated turns (same number, role and text) are one; turns that
share a number follow by role and text. Turns without a pair are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: How a turn is rendered, around its role and its text.
BEFORE, BETWEEN, AFTER = "<|", "|>\n", "\n<|end|>\n"


def _turn(side: str, pair: str) -> list[Column]:
    fields = [F.col(c).cast(kind).alias(c) for c, kind in (("turn", "long"), ("role", "string"), ("text", "string"))]
    turn = F.struct(*fields)
    return [F.col(f"`{pair}`").alias("pair_id"), F.lit(side).alias("side"), turn.alias("turn")]


def _ordered(side: str) -> Column:
    return F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("turn"))))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(BEFORE), F.coalesce(turn["role"], F.lit("unknown")), F.lit(BETWEEN))


def rendered(turn: Column) -> Column:
    return F.concat(_header(turn), F.coalesce(turn["text"], F.lit("")), F.lit(AFTER))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(
        F.slice(a, 1, n),
        lambda x, i: x["role"].eqNullSafe(F.get(b, i)["role"]) & x["text"].eqNullSafe(F.get(b, i)["text"]),
    )
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def trained(turns: Column) -> Column:
    """Ranges ``[begin, end)`` of characters of the rendered turns that the assistant writes, its end mark included."""

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn))
        end = state["at"] + F.length(rendered(turn))
        own = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == ASSISTANT, F.concat(state["ranges"], own)).otherwise(state["ranges"]).alias("ranges"),
        )

    empty = F.array().cast("array<struct<begin: int, end: int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("ranges"))
    return F.aggregate(turns, start, step, lambda state: state["ranges"])


def preference_examples(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id") -> DataFrame:
    """One row per pair of ``chosen`` and ``rejected`` turns ``(pair_id, turn, role, text)``.

    ``prompt_turns`` and ``prompt``, then for each side its completion and the ranges trained on.
    """
    both = chosen.select(*_turn("chosen", pair)).unionByName(rejected.select(*_turn("rejected", pair)))
    pairs = both.where("pair_id IS NOT NULL").groupBy("pair_id").agg(
        _ordered("chosen").alias("chosen"), _ordered("rejected").alias("rejected")
    )
    cut = pairs.withColumn("prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("prompt_turns") + 1, F.size(side))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, rendered), "")

    return cut.select(
        "pair_id",
        "prompt_turns",
        text(F.slice("chosen", 1, "prompt_turns")).alias("prompt"),
        text(rest("chosen")).alias("chosen"),
        trained(rest("chosen")).alias("chosen_trained"),
        text(rest("rejected")).alias("rejected"),
        trained(rest("rejected")).alias("rejected_trained"),
    )


def answers_swapped(conversations: DataFrame) -> DataFrame:
    """Rejected sides for ``conversations (conv_id, turn, role, text)``, as ``(pair_id, turn, role, text)``.

    Every conversation again, but for its last assistant turn, which is that of its neighbour: ids
    2n and 2n + 1 are neighbours. Without a neighbour's answer the turn is empty.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.where(F.col("role") == ASSISTANT).groupBy("pair_id").agg(
        F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last")
    )
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("answer"))
    swapped = last.select("pair_id", F.col("last.turn").alias("last_turn")).join(other, "pair_id", "left")
    is_last = (F.col("role") == ASSISTANT) & (F.col("turn") == F.col("last_turn"))
    text = F.when(is_last, F.coalesce("answer", F.lit(""))).otherwise(F.col("text"))
    return turns.join(swapped, "pair_id", "left").select("pair_id", "turn", "role", text.alias("text"))
