"""Conversations as one text each, that a parser reads back unchanged.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``; a conversation is its turns in order. The
parser is deterministic: turns begin at each ``<|im_start|>``, the role ends at the first line break,
the text at the first ``<|im_end|>``, and nothing but a line break may follow.

Every turn is written plainly, read back and compared with its source. A turn that comes back
changed is escaped: ``<``, any ``!``, ``|`` gets one more ``!``, so no control string is left in it,
and a line break in a role becomes ``<|nl|>``. The parser takes one ``!`` away again. Escaped turns
are compared once more; one that still differed would stop the job.

The loss mask has one entry per turn: where in the written turn the text to be learnt starts and how
many characters it has (those of role ``assistant``; 0 for others).

Rows are ordered by turn, then role, then text; nulls first. Null roles and texts count as empty,
rows with a null conv_id as one conversation. Repeated rows are repeated turns. Other columns
are ignored. A long conversation is put together in parts of ``PART`` turns first. Its text is one
value in the end, as the format asks.

Everything runs on DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "<|im_start|>"
END = "<|im_end|>"
BREAK = "<|nl|>"
LEARNT = "assistant"
PART = 64


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(!*)\|", r"<!$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<!(!*)\|", r"<$1|")


def written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted text, without the mark at their start."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    return F.when(F.length(formatted) > 0, F.slice(parts, F.lit(2), F.size(parts))).otherwise(
        F.array().cast("array<string>")
    )


def read_turn(piece: Column) -> Column:
    """Role and text of a piece, null if the piece breaks the grammar."""
    role_end = F.instr(piece, "\n")
    body = F.substr(piece, role_end + 1)
    text_end = F.instr(body, END)
    rest = F.substr(body, text_end + len(END))
    role = F.replace(F.substr(piece, F.lit(1), role_end - 1), F.lit(BREAK), F.lit("\n"))
    text = F.substr(body, F.lit(1), text_end - 1)
    return F.when(
        (role_end > 0) & (text_end > 0) & (rest == "\n"),
        F.struct(unescaped(role).alias("role"), unescaped(text).alias("text")),
    )


def _comes_back(turn: Column, role: Column, text: Column) -> Column:
    found = pieces(turn)
    read = read_turn(found[0])
    same = (read["role"] == role) & (read["text"] == text)
    return F.coalesce((F.size(found) == 1) & same, F.lit(False))


def format_chat(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and the loss mask ``loss`` of each conversation."""
    role, text, turn = F.col("role"), F.col("text"), F.col("written")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    safe_role = F.replace(escaped(role), F.lit("\n"), F.lit(BREAK))
    plain = rows.withColumn("plain", _comes_back(written(role, text), role, text))
    shown = plain.select(
        "*",
        F.when(F.col("plain"), role).otherwise(safe_role).alias("shown_role"),
        F.when(F.col("plain"), text).otherwise(escaped(text)).alias("shown_text"),
    ).withColumn("written", written(F.col("shown_role"), F.col("shown_text")))
    sure = F.when(F.col("plain") | _comes_back(turn, role, text), turn).otherwise(
        F.raise_error(F.lit("a turn cannot be read back"))
    )
    loss = F.struct(
        (F.length("shown_role") + 1).alias("start"),
        F.when(role == LEARNT, F.length("shown_text")).otherwise(0).alias("length"),
    )
    listed = F.struct("turn", "role", "text", sure.alias("written"), loss.alias("loss"))
    part = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / PART)
    parts = (
        shown.withColumn("part", F.when(F.col("turn").isNull(), F.lit(None)).otherwise(part))
        .groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(listed)).alias("turns"))
        .select(
            "conv_id",
            F.struct(
                "part",
                F.array_join("turns.written", "").alias("formatted"),
                F.col("turns.loss").alias("loss"),
            ).alias("piece"),
        )
    )
    return (
        parts.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("piece")).alias("all"))
        .select(
            "conv_id",
            F.array_join("all.formatted", "").alias("formatted"),
            F.flatten("all.loss").alias("loss"),
        )
    )


def read_chat(formatted: DataFrame) -> DataFrame:
    """Adds the ``turns`` (role, text) read from the text, and ``learnt``, what the mask shows."""
    under = lambda piece, mask: unescaped(
        F.substr(piece, mask["start"] + 1, mask["length"])
    )
    return formatted.select(
        "conv_id",
        "formatted",
        F.transform(pieces(F.col("formatted")), read_turn).alias("turns"),
        F.zip_with(pieces(F.col("formatted")), F.col("loss"), under).alias("learnt"),
    )
