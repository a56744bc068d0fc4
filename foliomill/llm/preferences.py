"""Preference formatting.

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (equal role and text, nulls equal to nulls) is rendered once as prompt;
what follows is rendered for each side as completion, with a mask of the
character spans to learn from: the texts and closing marks of assistant turns.

Turns are ordered by turn number, then role and text; turns with a null number
come first.  Null role: "unknown"; null text: empty.  A pair without a second
side, or with equal sides, has no completion to learn a preference from; its
status says so.  Conversations without id make no pair.  Repeated rows of a turn
are turns of their own.  No turns: no pairs.  Other columns don't matter.  A
conversation is one row of the result and is put together in one task; all else
grows with it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per id: turns, an ordered array of (turn, role, text)."""
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), turn.alias("t"))
    return rows.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def prefix_length(a: Column, b: Column) -> Column:
    """Number of leading turns with equal role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, n).cast("int")


def head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    """Spans [start, end) of the rendered turns that are learnt: text and end mark of assistant turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(head(t))
        end = start + F.length(t["text"]) + len(END)
        span = F.when(t["role"] == "assistant", F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], span).alias("spans"))

    return F.aggregate(turns, zero, add, lambda acc: acc["spans"])


def formatted(pairs: DataFrame) -> DataFrame:
    """pairs: id, chosen, rejected (arrays of turns, or null). Adds prompt, completions, masks, prompt_turns, status."""
    n = prefix_length(F.col("chosen"), F.col("rejected"))
    x = pairs.withColumn("prompt_turns", F.when(F.col("chosen").isNull() | F.col("rejected").isNull(), F.lit(0)).otherwise(n))
    rest = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(0)))
    x = x.withColumn("chosen_rest", rest("chosen")).withColumn("rejected_rest", rest("rejected"))
    status = F.when(F.col("chosen").isNull(), "no chosen").when(F.col("rejected").isNull(), "no rejected").when((F.size("chosen_rest") == 0) & (F.size("rejected_rest") == 0), "equal").otherwise("pair")
    return x.select(
        "id", "prompt_turns", status.alias("status"), F.coalesce(rendered(F.slice(F.coalesce("chosen", "rejected"), F.lit(1), F.col("prompt_turns"))), F.lit("")).alias("prompt"),
        rendered(F.col("chosen_rest")).alias("chosen"), rendered(F.col("rejected_rest")).alias("rejected"), mask(F.col("chosen_rest")).alias("chosen_mask"), mask(F.col("rejected_rest")).alias("rejected_mask"),
    )


def answer_pairs(turns: DataFrame, **columns: str) -> DataFrame:
    """Pairs from one table of conversations: chosen is a conversation, rejected the same with the text of its last assistant turn
    replaced by that of its neighbour's (the id that differs in the lowest bit), null where either is missing. Turns after it stay on both sides."""
    all_of = conversations(turns, **columns)
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i)))
    x = all_of.withColumn("last", last)
    other = x.where("last is not null").select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.get("turns", "last")["text"].alias("other"))
    x = x.join(other, "id", "left")
    replaced = F.transform("turns", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(i == F.col("last"), F.col("other")).otherwise(t["text"]).alias("text")))
    return x.select("id", F.col("turns").alias("chosen"), F.when(F.col("last").isNotNull() & F.col("other").isNotNull(), replaced).alias("rejected"))
