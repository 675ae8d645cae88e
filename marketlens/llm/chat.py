"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its text may be trained on.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: A control string begins with this in a formatted text; inside turns it is escaped.
MARK, ESCAPED_MARK = "<|", "<\\|"


def escape(text: Column) -> Column:
    """Texts without ``<|``: a backslash is doubled, then ``<|`` gets one between its signs.

    Reversible: after the first step runs of backslashes have even length,
    so a single one between ``<`` and ``|`` can only come from the second.
    """
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(MARK), F.lit(ESCAPED_MARK))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPED_MARK), F.lit(MARK)), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As :func:`escape`, and a line feed becomes ``<``, one backslash, ``n`` (a role ends at the first line feed)."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def format_examples(conversations: DataFrame) -> DataFrame:
    """One example per assistant turn, plus one without a target where a conversation ends otherwise.

    Takes conv_id, turn, role, text (other columns are ignored) and returns
    ``conv_id, example`` (number of the last turn in it, from 1), ``text``,
    ``loss_start, loss_end`` (code points of the trainable part, from 0, end
    excluded; null in an example without a target) and ``whole`` (the
    example holds every turn of its conversation).

    The example without a target keeps the format lossless: trailing user
    turns and conversations without an assistant turn are in the output too.
    Null roles and texts count as empty; rows are ordered by turn (null
    first), then role and text, so ties have one order; repeated rows are
    turns of their own; a null conv_id is a conversation.  An empty table
    gives an empty result.  One conversation is one training sequence and
    must fit a row; all its turns are gathered once, the examples are made
    one after another.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    cut = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END))).alias("parts"),
        F.transform("turns", lambda t: t["role"] == "assistant").alias("target"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("sizes"),
    )
    n = F.size("parts")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("target", i) | (i == n))
    example = cut.select("conv_id", "parts", "target", "sizes", F.explode(ends).alias("example"))
    text = F.array_join(F.slice("parts", 1, F.col("example")), "")
    stop = F.length("text") - len(END)
    return (example.select("conv_id", "example", text.alias("text"), F.element_at("target", F.col("example")).alias("trainable"),
                           F.element_at("sizes", F.col("example")).alias("size"), (F.col("example") == n).alias("whole"))
            .select("conv_id", "example", "text", F.when(F.col("trainable"), stop - F.col("size")).alias("loss_start"),
                    F.when(F.col("trainable"), stop).alias("loss_end"), "whole"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text), read from the text alone."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda p: p != "")
    bodies = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bodies, lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.locate("\n", b) + 1)).alias("text")))


def trained_text(text: Column, start: Column, end: Column) -> Column:
    return unescape(F.substr(text, start + 1, end - start))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, trainable text and formatted size."""
    read = examples.select(
        "conv_id", "example", F.length("text").cast("long").alias("chars"),
        F.when(F.col("whole"), F.col("text")).alias("full"),
        F.when(F.col("loss_start").isNotNull(), F.struct("example", trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("reply"))).alias("loss"))
    whole = read.groupBy("conv_id").agg(
        F.max("full").alias("full"), F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"), F.sort_array(F.collect_list("loss")).alias("loss"))
    turns = whole.select("*", parse_turns(F.col("full")).alias("turns"), F.array_join(F.transform("loss", lambda x: x["reply"]), "").alias("trained"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
