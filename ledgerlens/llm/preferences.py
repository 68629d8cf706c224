"""Preference formatting of chosen and rejected conversations.

Both sides of a pair are tables of turns. The longest common turn prefix (all
turns before the first turn number at which the two sides differ) is rendered
once as the prompt; the turns from there on are the chosen and the rejected
completion. Every row of the result is one rendered turn with its mask: in a
completion, what the assistant says and the end mark are trained on; headers,
other roles and the whole prompt are not. DataFrame operations only.

Scale: no conversation is gathered in a row or a task. Sides are compared by
an aggregate over (pair, turn, role, hash of the text), combined before its
shuffle, and the place of the first difference is a minimum per pair.

Edge cases: a null role or text counts as empty; rows that repeat a turn
number are compared as a set with counts; a row without a pair id or turn is
dropped (it belongs to no place); equal sides are all prompt; sides that differ
in their first turn have no prompt; template marks inside a text are broken up
by a space; an empty table gives an empty result; columns beyond the four are
not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .fingerprints import with_next

# fixed values: the marks of the template
START, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    """The text with template marks broken up."""
    return reduce(lambda t, mark: F.replace(t, F.lit(mark), F.lit(mark.replace("<|", "<| "))), (START, END), text)


def _side(turns: DataFrame, name: str, pair: str) -> DataFrame:
    return turns.filter(F.col(pair).isNotNull() & F.col("turn").isNotNull()).select(
        F.col(pair).alias("pair_id"), F.col("turn").cast("long").alias("turn"),
        text_of("role").alias("role"), text_of("text").alias("text"), F.lit(name).alias("side"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id") -> DataFrame:
    """``pair_id, part, turn, role, rendered, train_from, train_to`` from two
    tables ``(pair, turn, role, text)``; ``part`` is prompt, chosen or
    rejected; ``train_from`` and ``train_to`` are code points in ``rendered``
    (both 0 where nothing is trained on)."""
    both = _side(chosen, "chosen", pair).unionByName(_side(rejected, "rejected", pair))
    each = both.groupBy("pair_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("h")).agg(
        F.sum(F.when(F.col("side") == "chosen", 1).otherwise(0)).alias("c"),
        F.sum(F.when(F.col("side") == "rejected", 1).otherwise(0)).alias("r"))
    parts_at = F.min(F.when(F.col("c") != F.col("r"), F.col("turn")))
    first = each.groupBy("pair_id").agg(parts_at.alias("first"))
    rows = both.join(first, "pair_id").withColumn(
        "part", F.when(F.col("first").isNull() | (F.col("turn") < F.col("first")), "prompt").otherwise(F.col("side")))
    rows = rows.filter((F.col("part") != "prompt") | (F.col("side") == "chosen"))   # the prompt once
    head = F.concat(F.lit(START), _plain(F.col("role")), F.lit("\n"))
    body = F.concat(_plain(F.col("text")), F.lit(END))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return rows.select(
        "pair_id", "part", "turn", "role", F.concat(head, body, F.lit("\n")).alias("rendered"),
        F.when(trained, F.char_length(head)).otherwise(0).alias("train_from"),
        F.when(trained, F.char_length(head) + F.char_length(body)).otherwise(0).alias("train_to"))


def swapped_answers(turns: DataFrame, rows_per_range: int = 2048) -> tuple[DataFrame, DataFrame]:
    """Pairs from one table of conversations: chosen is the conversation,
    rejected the same with its last answer taken from the last answer of the
    conversation before it by id (the first takes that of the last).
    Conversations without an answer make no pair."""
    said = turns.filter((F.col("role") == "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    last = said.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.max(F.struct(
        F.col("turn").cast("long").alias("turn"), text_of("text").alias("text"))).alias("a"))
    other = with_next(last.select("conv_id", F.col("a.text").alias("_answer"), F.col("a.turn").alias("_last")),
                      "conv_id", ["_answer"], rows_per_range)
    other = other.select("conv_id", "_last", F.col("next._answer").alias("_other"))
    chosen = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                          "role", "text").join(other, "conv_id")
    swap = (F.col("role") == "assistant") & (F.col("turn") == F.col("_last"))
    rejected = chosen.withColumn("text", F.when(swap, F.col("_other")).otherwise(F.col("text")))
    columns = ["conv_id", "turn", "role", "text"]
    return chosen.select(columns), rejected.select(columns)
