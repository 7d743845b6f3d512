"""Preference formatting: one prompt and two masked completions for each pair of conversations.

The longest common turn prefix (equal role and text, turn by turn) of the chosen and the rejected conversation is rendered
once as the prompt. What follows in each is its completion, with the spans (code points, end exclusive) of assistant
turns; everything outside them is masked from the loss. Turns are ordered by number, then role and text.

Null roles and texts count as empty. ``<|`` in a text is written ``< |``, so no text can forge a marker. Pairs that lack a
side are left out. Equal conversations give empty completions. Rows without pair or side are left out. Repeated rows are turns
of their own. Extra columns are ignored, whatever their names. A pair is one row, as long as its conversations. Empty tables give
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def body(turn: Column) -> Column:
    return F.replace(turn["text"], F.lit("<|"), F.lit("< |"))


def rendered(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(head(t), body(t), F.lit("<|end|>\n"))))


def trained(turns: Column) -> Column:
    """``start:end`` of the assistant turns in the rendered text, comma-joined; the end marker is trained too."""
    def step(acc, t):
        start = acc["at"] + F.length(head(t))
        end = start + F.length(body(t)) + 7
        span = F.when(t["role"] == "assistant", F.array(F.concat_ws(":", start.cast("string"), end.cast("string")))).otherwise(F.expr("cast(array() as array<string>)"))
        return F.struct((end + 1).cast("int").alias("at"), F.concat(acc["out"], span).alias("out"))

    return F.concat_ws(",", F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")), step, lambda acc: acc["out"]))


def format_pairs(turns: DataFrame) -> DataFrame:
    """``turns`` has ``pair_id, chosen`` (boolean), ``turn, role, text``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    row = F.struct(F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    side = lambda good: F.sort_array(F.collect_list(F.when(F.col("chosen") == good, row)))
    pairs = turns.where("pair_id is not null and chosen is not null").groupBy("pair_id").agg(side(True).alias("a"), side(False).alias("b")).where("size(a) > 0 and size(b) > 0")
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    pairs = pairs.withColumn("n", (F.array_position(F.concat(same, F.array(F.lit(False))), False) - 1).cast("int"))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    return pairs.select("pair_id", F.col("n").alias("prompt_turns"), rendered(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"), rendered(rest("a")).alias("chosen"), trained(rest("a")).alias("chosen_spans"), rendered(rest("b")).alias("rejected"), trained(rest("b")).alias("rejected_spans"))
