"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its text under the loss mask.
Turns after the last assistant turn, or a conversation without one, are kept in one more example without loss, so that the
whole conversation can be read back from the output.

A turn is written ``<|turn|>role<|text|>text<|end|>``. In roles and texts the three characters that control strings
start with are escaped (``\\`` as ``\\s``, ``<`` as ``\\l``, ``[`` as ``\\b``), so no text can look like a mark, and
unescaping gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\b"), F.lit("[")), F.lit("\\l"), F.lit("<"))
    return F.replace(text, F.lit("\\s"), F.lit("\\"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per example of ``turns(conv_id, turn, role, text)``.

    Returns conv_id, example (from 0), n_turns (turns in it), text, loss_start and loss_end (code points of the trainable text, end
    exclusive; equal without loss). Rows are put in the order of turn, then role, then text, nulls first; a null role or text
    is empty. Rows that repeat a turn are turns of their own. A null conv_id is a conversation like any other. Other columns
    are not used. A conversation is one cell of text by the nature of the method, so it is gathered whole.
    """
    held = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    conversations = held.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = conversations.withColumn("turns", F.transform("turns", lambda t: F.struct(
        (t["role"] == "assistant").alias("trained"), escape(t["text"]).alias("text"),
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"))))
    written = written.withColumn("whole", F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(END))))
    last = F.size("turns") - 1
    # Generators see each turn with its number; only the targets go on.
    each = written.select("conv_id", "turns", "whole", F.posexplode(F.transform("turns", lambda t: t["trained"])).alias("at", "trained"))
    each = each.where(F.col("trained") | (F.col("at") == last))
    target = F.element_at("turns", F.col("at") + 1)
    context = F.array_join(F.slice("whole", F.lit(1), F.col("at")), "")
    start = F.length(context) + F.length(target["head"])
    made = each.select(
        "conv_id", "at", (F.col("at") + 1).alias("n_turns"), F.concat(context, F.element_at("whole", F.col("at") + 1)).alias("text"),
        start.alias("loss_start"), F.when(F.col("trained"), start + F.length(target["text"])).otherwise(start).alias("loss_end"),
        F.size(F.filter(F.slice("turns", F.lit(1), F.col("at")), lambda t: t["trained"])).alias("example"))
    return made.select("conv_id", "example", "n_turns", "text", "loss_start", "loss_end")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of an example's text."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text")))
