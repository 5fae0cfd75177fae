"""Preference formatting: a pair of conversations becomes one prompt and two masked completions.

Turns are numbered and compared as rows, so a conversation of any length is spread over tasks and
never gathered into one value. The prompt is the longest common prefix of turns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.operators.ordered import running
from forumlens.session import staged

WIDTH = 1024


def numbered(turns: DataFrame, keys: Sequence[str], turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(keys, pos, role, text) with positions 0, 1, ... in order of turn, then role, then text; nulls first.

    Long conversations are cut into stretches of turn numbers that are numbered alone and shifted by
    the sizes of the stretches before.
    """
    part = F.coalesce(F.floor(F.col(turn) / WIDTH), F.lit(-(2**62))).alias("_part")
    rows = turns.select(*keys, F.col(turn).alias("_turn"), F.col(role).alias("role"), F.col(text).alias("text"), part)
    # Written once: the pairing behind it is read for sizes and for numbers.
    rows = staged(rows, "turns")
    sizes = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_part").orderBy("_turn", "role", "text")
    local = rows.withColumn("_in", F.row_number().over(inside) - 1)
    return local.join(shifts, [*keys, "_part"]).select(*keys, (F.col("_in") + F.col("_shift")).alias("pos"), "role", "text")


def rendered(role: Column, text: Column) -> Column:
    """One turn as text; a null role or text counts as empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, keys: Sequence[str], answer_role: str = "assistant") -> DataFrame:
    """Rows of prompts and completions from turns (keys, turn, role, text) of both sides.

    One row per rendered turn: keys, part (prompt, chosen or rejected), pos, rendered, start and
    length in code points inside prompt + completion, and masked, which is false only for answers
    in a completion: those are what the loss counts. The common prefix is rendered once. Two equal
    conversations give a prompt and no completion; a side without turns gives only the other's
    completion. Equal means equal in role and text, null equalling null. Keys must not be null;
    repeated turns are numbered one after the other; other columns are not read; empty tables give
    no rows.
    """
    # Both are read three times, the split twice; stored, they keep the plan and the driver small.
    a, b = staged(numbered(chosen, keys), "chosen"), staged(numbered(rejected, keys), "rejected")
    left = a.select(*keys, "pos", F.struct("role", "text").alias("l"), F.lit(1).alias("in_l"))
    right = b.select(*keys, "pos", F.struct("role", "text").alias("r"), F.lit(1).alias("in_r"))
    met = left.join(right, [*keys, "pos"], "full")
    same = F.col("in_l").isNotNull() & F.col("in_r").isNotNull() & F.col("l").eqNullSafe(F.col("r"))
    # Without a difference the prefix is everything.
    split = met.groupBy(*keys).agg(F.coalesce(F.min(F.when(~same, F.col("pos"))), F.max("pos") + 1).alias("_split"))
    split = staged(split, "split")

    def side(turns: DataFrame, name: str, with_prompt: bool) -> DataFrame:
        rows = turns.select(*keys, "pos", "role", rendered(F.col("role"), F.col("text")).alias("rendered"))
        rows = running(rows, list(keys), "pos", {"_end": ("sum", F.length("rendered"))})
        rows = rows.join(split, list(keys))
        inside = F.col("pos") < F.col("_split")
        rows = rows if with_prompt else rows.where(~inside)
        return rows.select(
            *keys,
            F.when(inside, F.lit("prompt")).otherwise(F.lit(name)).alias("part"),
            "pos",
            "rendered",
            (F.col("_end") - F.length("rendered")).cast("long").alias("start"),
            F.length("rendered").cast("long").alias("length"),
            (inside | ~F.coalesce(F.col("role") == answer_role, F.lit(False))).alias("masked"),
        )

    return side(a, "chosen", True).unionByName(side(b, "rejected", False))


def conversation_pairs(conversations: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns (conv_id, other_id, kind, turn, role, text) out of recorded conversations.

    Kind ``answer``: the last answer of a conversation against the last answer of the next one that
    ``after`` (conv_id, other_id) names, put in its place. Kind ``first_turn``: conversations that
    open with the same turn, the one with the smallest id chosen against each of the others, so a
    group of n gives n - 1 pairs. Conversations without an answer take no part in the first kind.

    ``turn`` becomes the place of a message, numbered as in :func:`numbered`: of messages with one turn
    number (or none) the last by role and text is the last, and only the message at that place is replaced. Repeated
    messages are messages of their own. Rows without conv_id are left out; an empty table gives no turns.
    """
    known = conversations.where("conv_id is not null")
    turns = staged(numbered(known, ["conv_id"]).withColumnRenamed("pos", "turn"), "numbered")
    answers = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max_by(F.struct("turn", "text"), "turn").alias("last"))
    own = answers.select("conv_id", F.col("last.turn").alias("at"))
    borrowed = answers.select(F.col("conv_id").alias("other_id"), F.col("last.text").alias("text"))
    pairs = after.join(own, "conv_id").join(borrowed, "other_id").select("conv_id", "other_id", F.lit("answer").alias("kind"), "at", F.col("text").alias("b"))
    ids = ["conv_id", "other_id", "kind"]
    upto = turns.join(pairs, "conv_id").where("turn <= at")
    last = F.col("turn") == F.col("at")
    by_answer = upto.select(*ids, "turn", "role", "text"), upto.select(*ids, "turn", "role", F.when(last, F.col("b")).otherwise(F.col("text")).alias("text"))
    first = turns.where("turn = 0").select("conv_id", F.struct("role", "text").alias("opening"))
    opened = first.select("conv_id", F.xxhash64("opening").alias("h"), F.hash("opening").alias("g"))
    heads = opened.groupBy("h", "g").agg(F.min("conv_id").alias("head"), F.count("*").alias("n")).where("n > 1")
    stars = opened.join(heads, ["h", "g"]).where("conv_id != head").select(
        F.col("head").alias("conv_id"), F.col("conv_id").alias("other_id"), F.lit("first_turn").alias("kind")
    )
    chosen = turns.join(stars, "conv_id").select(*ids, "turn", "role", "text")
    others = turns.withColumnRenamed("conv_id", "other_id").join(stars, "other_id").select(*ids, "turn", "role", "text")
    return by_answer[0].unionByName(chosen), by_answer[1].unionByName(others)
