r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; runs of adjacent
turns of one role become one block; blocks are concatenated:

    <|role|>\n text [<|more|> text]... <|end|>\n

Inside roles and texts ``&``, ``<`` and ``>`` are written ``&amp;``, ``&lt;``
and ``&gt;``, so that a text never holds a marker, and every turn can be read
back exactly.  ``segments`` is the same string cut into pieces with a flag: the
pieces under the loss mask are the assistant's texts.

Defined results: a null text or role counts as empty; turns sort by turn (nulls
first), then role, then text, so ties and repeated rows are all kept in a fixed
order; a null ``conv_id`` is a conversation of its own; other columns are
ignored; an empty table gives no rows.  The output has one row, and so one
string, for each conversation: Spark's 2 GB limit for a value bounds the length
of one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ASSISTANT = "assistant"
# The template's marks.
OPEN, HEAD_END, MORE, END = "<|", "|>\n", "<|more|>", "<|end|>\n"


def escape(text: Column) -> Column:
    for plain, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    for plain, mark in ((">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _blocks(turns: Column) -> Column:
    """Runs of one role: array of struct(role, texts), in one linear pass."""
    def cut(starts: Column) -> Column:
        return F.transform(starts, lambda s, k: F.struct(
            F.get(turns, s)["role"].alias("role"),
            F.transform(
                F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - s),
                lambda t: t["text"]).alias("texts")))

    return let(F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])), cut)


def _segments(blocks: Column) -> Column:
    """Each block's head, texts with separators, and end, flagged for the loss mask."""
    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def one(block: Column) -> Column:
        asked = block["role"] == ASSISTANT
        head = piece(F.concat(F.lit(OPEN), escape(block["role"]), F.lit(HEAD_END)), F.lit(False))
        texts = F.flatten(F.transform(block["texts"], lambda t, k: F.array(
            piece(F.when(k == 0, F.lit("")).otherwise(F.lit(MORE)), F.lit(False)), piece(escape(t), asked))))
        return F.concat(F.array(head), texts, F.array(piece(F.lit(END), F.lit(False))))

    return F.flatten(F.transform(blocks, one))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (text, loss)."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (
        conversations.select("conv_id", turn.alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", let(F.col("turns"), lambda t: _segments(_blocks(t))).alias("segments"))
        .select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array of struct(role, text), unescaped."""
    def turns(block: Column) -> Column:
        role = unescape(F.substr(F.substring_index(block, HEAD_END, 1), F.lit(len(OPEN) + 1)))
        body = F.substr(block, F.length(F.substring_index(block, HEAD_END, 1)) + len(HEAD_END) + 1)
        return F.transform(F.split(body, r"<\|more\|>"), lambda t: F.struct(
            role.alias("role"), unescape(t).alias("text")))

    found = F.split(formatted, r"<\|end\|>\n")
    return F.flatten(F.transform(F.slice(found, 1, F.size(found) - 1), turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output of :func:`format_conversations`."""
    return (
        formatted
        .select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                loss_text(F.col("segments")).alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
                t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars")))
