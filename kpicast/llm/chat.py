"""Prefix-target expansion of conversations, in DataFrame functions only.

Template: ``<s>`` and then, for every turn, ``[INST]role[/INST]text</s>``. Role and
text are escaped: a backslash follows every ``<``, ``[`` and backslash of the
original, so no control string can occur inside them and every two characters that
start with one of the three stand for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and the array of its turns (role, text) in order. One value has to
    hold a whole conversation, as an example holds all preceding turns. Null role or
    text counts as empty; turns with equal numbers are ordered by role, then text;
    null turn numbers come first; repeated rows stay; other columns are left out."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def expand(convs: DataFrame) -> DataFrame:
    """One example per assistant turn: conv_id, example (from 0), formatted, and the
    trainable characters loss_start (from 0) and loss_length, which cover the reply.

    Turns after the last reply, or a conversation without any, come as one more
    example with nothing to train on, so that no turn is lost.
    """
    piece = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(OPEN), escaped(t["role"]), F.lit(CLOSE), escaped(t["text"]), F.lit(END)
        ),
    )
    replies = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.element_at("turns", i)["role"] == F.lit("assistant"),
    )
    ends = F.when(F.element_at("turns", -1)["role"] == F.lit("assistant"), F.col("replies"))
    ends = ends.otherwise(F.array_append("replies", F.size("turns")))
    trained = F.element_at("turns", F.col("upto"))["role"] == F.lit("assistant")
    reply = F.length(escaped(F.element_at("turns", F.col("upto"))["text"]))
    return (
        convs.withColumn("pieces", piece)
        .withColumn("replies", replies)
        .select("conv_id", "turns", "pieces", F.posexplode(ends).alias("example", "upto"))
        .withColumn(
            "formatted",
            F.concat(F.lit(BEGIN), F.array_join(F.slice("pieces", F.lit(1), F.col("upto")), "")),
        )
        .withColumn("loss_length", F.when(trained, reply).otherwise(0))
        .withColumn("loss_start", F.length("formatted") - len(END) - F.col("loss_length"))
        .select("conv_id", "example", "formatted", "loss_start", "loss_length")
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of an example."""
    body = F.substring(formatted, len(BEGIN) + 1, 2147483647)
    pieces = F.filter(F.split(body, END, -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(F.substring(p, len(OPEN) + 1, 2147483647), CLOSE, 1)).alias("role"),
            unescaped(F.substring_index(p, CLOSE, -1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescaped(F.substring(formatted, start + 1, length))


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples. The longest example
    holds all turns; every reply is under one mask."""
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    reply = F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("text"))
    grouped = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_sort(F.collect_list(F.when(F.col("loss_length") > 0, reply))).alias("replies"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    read = grouped.withColumn("turns", read_turns(F.col("longest"))).withColumn(
        "loss", F.array_join(F.transform("replies", lambda r: r["text"]), "")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
