"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
text is under the loss mask. Turns after the last assistant turn (or a conversation without one)
become a last example with an empty mask, so that the output holds every turn.

A rendered turn is ``<|turn|>ROLE\\nTEXT<|end|>\\n``. In roles and texts a backslash is doubled, and one
is put inside whatever looks like a control string, of this template or of other common ones, so
that none is left; a line break in a role follows a backslash. ``unescape`` reverses all of it.

Null text or role: empty. Null ``turn`` sorts first, ties sort by role and text, repeated rows are
turns of their own, rows without ``conv_id`` are one conversation. No rows: no examples. Only the
four columns below are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
#: Opening character and rest of each kind of control string: ``<|name|>``, ``<s>``, ``[INST]``, ``<<SYS>>``.
CONTROL = r"([<\[])(\||/?s>|</?SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to examples.

    Returns conv_id, example (from 1), formatted, loss_start, loss_end: code points of ``formatted``,
    end exclusive, equal where nothing is trainable.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    shown = talks.select(
        "conv_id",
        F.transform("t", lambda x: F.struct(
            (x["role"] == "assistant").alias("reply"),
            F.concat(F.lit(TURN), F.regexp_replace(escape(x["role"]), "\n", "\\\\\n"), F.lit("\n")).alias("head"),
            escape(x["text"]).alias("body"),
        )).alias("t"),
    ).withColumn("n", F.size("t"))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.element_at("t", i)["reply"] | (i == F.col("n")))
    examples = shown.select("conv_id", "t", F.posexplode(ends).alias("at", "last")).select(
        "conv_id",
        (F.col("at") + 1).cast("long").alias("example"),
        F.element_at("t", F.col("last")).alias("target"),
        F.array_join(F.transform(F.slice("t", 1, F.col("last") - 1), lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("context"),
    )
    start = F.length("context") + F.length("target.head")
    return examples.select(
        "conv_id",
        "example",
        F.concat("context", "target.head", "target.body", F.lit(END)).alias("formatted"),
        start.cast("long").alias("loss_start"),
        (start + F.when(F.col("target.reply"), F.length("target.body")).otherwise(0)).cast("long").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted text, as structs (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substr(p, F.lit(len(TURN) + 1)))
    heads = F.transform(bare, lambda p: F.struct(F.regexp_extract(p, r"\A((?:[^\\\n]++|\\[\s\S])*+)\n", 1).alias("head"), p.alias("p")))
    return F.transform(heads, lambda x: F.struct(
        unescape(x["head"]).alias("role"),
        unescape(F.substr(x["p"], F.length(x["head"]) + 2)).alias("text"),
    ))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the mask, unescaped."""
    return unescape(F.substr(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples: the last one holds all turns."""
    parts = examples.select(
        "conv_id", "example", "formatted", F.length("formatted").alias("n"), loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    # of all formatted texts only the last one is kept while they are grouped, so a row is no longer than a conversation
    talks = parts.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"), F.sum("n").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("e"))
    read = talks.select("conv_id", read_turns(F.col("last")).alias("turns"), F.array_join(F.transform("e", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
