"""Chat formatting with Spark expressions only: one string per conversation and the runs of it that carry loss.

A block is `<|im_start|>role\\n` texts `<|im_end|>\\n`. Neighbouring turns of one role share a block and are parted by
`<|im_next|>`. Inside roles and texts a backslash is doubled and `<|` becomes `<\\|`, so markers cannot be forged and the
turns can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template. All begin with `<|`, which no escaped text holds.
START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _role(role: Column) -> Column:
    """Escaped, on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    # a line break is the only backslash before an n that is not one of a pair
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def formatted(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, loss_role: str = "assistant") -> DataFrame:
    """(conversation, formatted, loss_runs) with one row per conversation.

    loss_runs holds (start, length) in code points, from 1, of each text of `loss_role`, escaped as it stands. NULL roles and
    texts are empty; turns with the same number are ordered by role and text, repeated rows stay repeated; rows without a
    conversation id form one conversation; no rows give no rows; other columns are left out. One shuffle by conversation;
    a task holds whole conversations, which is what it writes.
    """
    row = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    convs = turns.select(F.col(conv_col).alias("conv"), row.alias("t")).groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    opens = lambda t, i: (i == 0) | (F.get("ts", i - 1)["role"] != t["role"])
    closes = lambda t, i: (i == F.size("ts") - 1) | (F.get("ts", i + 1)["role"] != t["role"])
    pieces = F.transform("ts", lambda t, i: F.struct(
        F.when(opens(t, i), F.concat(F.lit(START), _role(t["role"]), F.lit("\n"))).otherwise(F.lit(NEXT)).alias("before"),
        escaped(t["text"]).alias("text"),
        F.when(closes(t, i), F.lit(f"{END}\n")).otherwise(F.lit("")).alias("after"),
        (t["role"] == loss_role).alias("loss"),
    ))
    convs = convs.withColumn("ps", pieces)
    runs = "struct<at:int,runs:array<struct<start:int,length:int>>>"
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("runs")).cast(runs)

    def step(acc, p):
        start = acc["at"] + F.length(p["before"])
        run = F.struct(start.alias("start"), F.length(p["text"]).alias("length"))
        return F.struct(
            (start + F.length(p["text"]) + F.length(p["after"])).alias("at"),
            F.when(p["loss"], F.array_append(acc["runs"], run)).otherwise(acc["runs"]).alias("runs"),
        )

    text = F.array_join(F.transform("ps", lambda p: F.concat(p["before"], p["text"], p["after"])), "")
    return convs.select(F.col("conv").alias(conv_col), text.alias("formatted"), F.aggregate("ps", zero, step, lambda acc: acc["runs"]).alias("loss_runs"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds `turns`, an array of (role, text) parsed from `formatted`, and `loss_texts`, the texts under the loss runs."""
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)
    df = chats.withColumn("_b", F.transform(blocks, lambda b: F.struct(
        F.substring_index(b, "\n", 1).alias("role"),
        F.split(F.regexp_replace(F.regexp_replace(b, r"^[^\n]*\n", ""), r"<\|im_end\|>\n$", ""), r"<\|im_next\|>", -1).alias("texts"),
    )))
    turns = F.flatten(F.transform("_b", lambda b: F.transform(b["texts"], lambda x: F.struct(_role_back(b["role"]).alias("role"), unescaped(x).alias("text")))))
    loss = F.transform("loss_runs", lambda r: unescaped(F.substring(F.col("formatted"), r["start"], r["length"])))
    return df.select(*chats.columns, turns.alias("turns"), loss.alias("loss_texts"))
