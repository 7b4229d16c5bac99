"""Prefix-target chat examples: each assistant turn with all turns before it, only the reply trainable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CLOSE = f"{END}\n"


def escape(text: Column) -> Column:
    """No control string survives: ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def format_turn(role: Column, text: Column) -> Column:
    """One turn of the template; a role outside ``[A-Za-z0-9_.*-]`` is percent-encoded."""
    return F.concat(F.lit(START), F.url_encode(role), F.lit("\n"), escape(text), F.lit(_CLOSE))


def prefix_examples(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per assistant turn: ``conv_id, target, last, text, loss_start, loss_end``.

    ``target`` is the place (from 1) of the turn the example ends with, ``text`` the formatted turns up to
    it, and ``loss_start``/``loss_end`` the code-point range of ``text`` under the loss mask: the reply,
    without marks. A conversation that ends otherwise gets one more example with all its turns and an
    empty mask, so the output holds every turn; ``last`` marks the example that holds all.

    Turns are taken by turn number, nulls first, ties by role, then text. Null texts and roles count as
    empty, null ids form one conversation, repeated rows are turns of their own, other columns are
    not read, an empty table gives an empty result. The output is as large as all prefixes together;
    a conversation's turns meet in one task, since its longest example is one row anyway.
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    n = F.size("turns")
    replies = F.filter(
        F.sequence(F.lit(1), n), lambda i: (F.element_at("turns", i)["role"] == trained_role) | (i == n)
    )
    formatted = whole.select(
        "conv_id",
        F.transform("turns", lambda t: format_turn(t["role"], t["text"])).alias("pieces"),
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        replies.alias("targets"),
    )
    examples = formatted.select("conv_id", "pieces", "roles", F.explode("targets").alias("target"))
    piece = F.element_at("pieces", F.col("target"))
    marks = F.length(F.lit(_CLOSE))
    trained = F.element_at("roles", F.col("target")) == trained_role
    body = F.length(piece) - F.length(F.substring_index(piece, "\n", 1)) - 1 - marks
    return examples.select(
        "conv_id",
        "target",
        (F.col("target") == F.size("pieces")).alias("last"),
        F.array_join(F.slice("pieces", 1, F.col("target")), "").alias("text"),
        F.when(trained, body).otherwise(0).alias("_loss"),
    ).select(
        "conv_id",
        "target",
        "last",
        "text",
        (F.length("text") - marks - F.col("_loss")).alias("loss_start"),
        (F.length("text") - marks).alias("loss_end"),
    )


def trained_text(examples: DataFrame) -> Column:
    """What lies under the mask, unescaped."""
    start, end = examples["loss_start"], examples["loss_end"]
    return unescape(F.substring(examples["text"], start + 1, end - start))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, read back: array of (role, text)."""
    pieces = F.split(text, r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        size = F.length(piece) - F.length(head) - 1 - len(_CLOSE)
        return F.struct(
            F.url_decode(head).alias("role"),
            unescape(F.substring(piece, F.length(head) + 2, size)).alias("text"),
        )

    return F.transform(F.slice(pieces, 2, F.size(pieces)), turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: counts and SHA-256 digests of turns and trained text."""
    turns = F.when(F.col("last"), read_turns(F.col("text")))
    parts = examples.select(
        "conv_id",
        "target",
        F.length("text").cast("long").alias("chars"),
        trained_text(examples).alias("reply"),
        turns.alias("turns"),
    ).select(
        "conv_id",
        "target",
        "chars",
        "reply",
        F.size("turns").alias("n"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
            256,
        ).alias("sha"),
    )
    grouped = parts.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("target", "reply"))), lambda r: r["reply"]), ""
        ).alias("replies"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("replies").cast("long").alias("loss_chars"),
        F.sha2("replies", 256).alias("loss_sha256"),
        "formatted_chars",
    )
