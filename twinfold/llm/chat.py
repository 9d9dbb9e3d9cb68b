"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context and only its text is trainable.
A conversation that does not end with an assistant turn gets one more example without a target, so that the output
holds every turn. Turns are written as ``<|im_start|>role<|im_sep|>text<|im_end|>``. A backslash goes before each
backslash and inside each control string of a role or text, so a text never holds a mark, and one rule reverts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import pick

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TARGET = "assistant"
#: Control strings start with < or [ and go on like this.
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|/?SYS>>|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, example (0, 1, ...), text, loss_start and loss_chars (the trainable code points of ``text``),
    trainable, whole (the example that holds all turns). Turns go by ``turn`` (null first),
    then role and text; rows with the same turn all stay. Null roles and texts are empty; a null conv_id is a
    conversation. An empty table has no examples.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text")
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    head = lambda r: F.concat(F.lit(START), escape(r["role"]), F.lit(SEP))
    written = F.transform(
        "rows",
        lambda r: F.struct(
            (r["role"] == TARGET).alias("target"),
            head(r).alias("head"),
            escape(r["text"]).alias("body"),
        ),
    )
    convs = convs.select("conv_id", written.alias("rows"))
    n = F.size("rows")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("rows", i)["target"] | (i == n))
    cut = convs.select("conv_id", "rows", F.posexplode(ends).alias("example", "upto"))
    last = F.element_at("rows", F.col("upto"))
    turn = lambda r: F.concat(r["head"], r["body"], F.lit(END))
    context = F.array_join(F.transform(F.slice("rows", 1, F.col("upto") - 1), turn), "")
    cut = cut.select(
        "conv_id",
        "example",
        F.concat(context, last["head"]).alias("before"),
        last["body"].alias("body"),
        last["target"].alias("trainable"),
        (F.col("upto") == n).alias("whole"),
    )
    return cut.select(
        "conv_id",
        "example",
        F.concat("before", "body", F.lit(END)).alias("text"),
        F.length("before").cast("long").alias("loss_start"),
        F.when(F.col("trainable"), F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        "trainable",
        "whole",
    )


def turns_of(text: Column) -> Column:
    """Read an example's text back: array of (role, text)."""
    pieces = F.split(F.regexp_replace(text, r"\Q" + END + r"\E$", ""), r"\Q" + END + r"\E", -1)
    mark = F.lit(SEP)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        at = F.instr(body, SEP)
        return F.struct(
            unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(body, at + F.length(mark), F.length(body))).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """What lies under the loss mask, unescaped."""
    return unescape(F.substring(text, start.cast("int") + 1, chars.cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    loss = F.when(F.col("trainable"), loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).otherwise("")
    turns = turns_of(F.col("text"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    said = examples.select(
        "conv_id",
        F.struct("example", loss.alias("loss")).alias("said"),
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("whole"), F.size(turns)).cast("long").alias("n_turns"),
        F.when(F.col("whole"), F.sha2(lines, 256)).alias("turns_sha256"),
    )
    said = said.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.array_join(F.collect_list("turns_sha256"), "").alias("turns_sha256"),
        F.array_join(F.array_sort(F.collect_list("said"))["loss"], "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss_chars, loss_sha256 = F.length("loss").cast("long"), F.sha2("loss", 256)
    return said.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        loss_chars.alias("loss_chars"),
        loss_sha256.alias("loss_sha256"),
        "formatted_chars",
    )
