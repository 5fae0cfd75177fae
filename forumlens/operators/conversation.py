"""History-dependent columns of conversations (conv_id, turn, role, text).

``turn`` only orders the messages of a conversation; it may start anywhere and leave gaps. What
counts is a message's position.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.text import token_estimate
from forumlens.operators.ordered import WIDTH, lookback, previous_value, running

KEYS = ["conv_id"]


def _placed(turns: DataFrame, width: int) -> DataFrame:
    """Add ``_pos``, the number of earlier messages."""
    counted = running(turns, KEYS, "turn", {"_pos": ("sum", F.lit(1))}, width)
    return counted.withColumn("_pos", F.col("_pos") - 1)


def recent_history(turns: DataFrame, pairs: int = 6, width: int = WIDTH) -> DataFrame:
    """``history``: the last 2 x pairs messages before this one as "role: text" lines."""
    line = F.concat("role", F.lit(": "), "text")
    made = {"_h": lambda w: F.collect_list(F.struct("turn", line.alias("t"))).over(w)}
    out = lookback(_placed(turns, width), KEYS, "_pos", 2 * pairs, made, width)
    return out.withColumn("history", F.array_join(_texts("_h"), "\n")).drop("_h", "_pos")


def _texts(column: str) -> Column:
    return F.transform(F.sort_array(column), lambda s: s["t"])


def history_summary(turns: DataFrame, back: int = 4, chars: int = 50, width: int = WIDTH) -> DataFrame:
    snippet = F.concat("role", F.lit(": "), F.left("text", F.lit(chars)), F.lit("..."))
    made = {"_h": lambda w: F.collect_list(F.struct("turn", snippet.alias("t"))).over(w)}
    out = lookback(_placed(turns, width), KEYS, "_pos", back, made, width)
    summary = F.when(F.size("_h") == 0, F.lit("No prior history.")).otherwise(
        F.concat(F.lit("Conversation history summary: "), F.array_join(_texts("_h"), " "))
    )
    return out.withColumn("history_summary", summary).drop("_h", "_pos")


def repeat_counts(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per user message, how many times in a row it has just been repeated (0 for a new one).

    Position minus the latest position at which the text changed; both run over buckets.
    """
    asked = turns.where(F.col("role") == "user")
    asked = previous_value(asked, KEYS, "turn", "text", "_before", width)
    asked = running(asked, KEYS, "turn", {"_at": ("sum", F.lit(1))}, width)
    changed = F.col("_before").isNull() | (F.col("_before") != F.col("text"))
    out = running(asked, KEYS, "turn", {"_from": ("max", F.when(changed, F.col("_at")))}, width)
    return out.withColumn("repeats", F.col("_at") - F.col("_from")).drop("_before", "_at", "_from")


def kept_history(
    turns: DataFrame, prompt_tokens: Column, budget: float = 8192.0, width: int = WIDTH, texts: bool = False
) -> DataFrame:
    """For every user message, the part of the earlier messages that fits the token budget.

    The two oldest messages are dropped while the estimate is over budget and more than two are
    left. ``prompt_tokens`` is the fixed cost of instructions and current prompt. A message costs
    at least 100, so only ``budget / 100`` earlier messages can matter. ``texts`` adds ``history``, the
    kept messages as "role: text" lines.
    """
    back = math.ceil(budget / 100) + 2
    sized = _placed(turns, width).withColumns(
        {"_cost": token_estimate(F.col("text")), "_left": F.lit(float(budget)) - prompt_tokens}
    )
    said = [F.concat("role", F.lit(": "), "text").alias("t")] if texts else []
    item = F.struct(F.col("turn").alias("turn"), F.col("_cost").alias("cost"), *said)
    made = {"_h": lambda w: F.collect_list(item).over(w)}
    out = lookback(sized, KEYS, "_pos", back, made, width).where(F.col("role") == "user")
    # Walk back from the newest message; count how many fit.
    start = F.struct(F.lit(0.0).alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def walk(acc: Column, h: Column) -> Column:
        fits = acc["open"] & (acc["used"] + h["cost"] <= F.col("_left"))
        return F.struct(
            F.when(fits, acc["used"] + h["cost"]).otherwise(acc["used"]).alias("used"),
            (acc["n"] + fits.cast("int")).alias("n"),
            fits.alias("open"),
        )

    fitting = F.aggregate(F.reverse(F.sort_array("_h")), start, walk)["n"].cast("bigint")
    before = F.col("_pos")
    # Messages go in pairs from the front, and one or two always stay.
    dropped = F.least(
        F.ceil((before - fitting) / 2) * 2, F.greatest(F.ceil((before - 2) / 2) * 2, F.lit(0))
    )
    n_kept = before - dropped
    last = F.reverse(F.slice(F.reverse(F.sort_array("_h")), 1, n_kept.cast("int"))) if texts else None
    lines = [F.array_join(F.transform(last, lambda s: s["t"]), "\n").alias("history")] if texts else []
    return out.select("conv_id", "turn", before.alias("n_before"), n_kept.alias("n_kept"), dropped.alias("first_kept"), *lines)
