"""Chat formatting of logged conversations.

Logs hold snapshots: a conversation is there again each time it grew. Every prefix
of the turns of a conversation has a hash that is the exclusive or of the hashes
of its turns with their numbers, in 128 bits, so prefixes are summed in blocks of
turns. An anti-join removes conversations whose turns are a prefix of a longer
one's; those that stay are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import stage

#: Turn numbers that one window sorts at most of a conversation.
BLOCK = 1000


def numbered(turns: DataFrame) -> DataFrame:
    """``conv, n, role, text, block``: turns with their place from 1, in order of turn, role and text.

    ``turns`` are ``conv_id, turn, role, text``; rows repeated whole count once, a
    null role or text is empty, turns without a number come first.
    """
    rows = turns.select(
        F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).alias("block"),
    ).distinct()
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    rows = stage(rows.withColumn("n", F.row_number().over(inside)).drop("turn"), "turns")
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return rows.join(starts, same).select("conv", (F.col("n") + F.col("before")).alias("n"), "role", "text", "block")


def maximal(rows: DataFrame) -> DataFrame:
    """``conv, turns``: of numbered rows, the conversations that are no prefix of a longer one; of equal ones the smallest."""
    hashed = stage(
        rows.select("conv", "block", "n", F.xxhash64("n", "role", "text").alias("x"), F.xxhash64(F.lit(7), "n", "role", "text").alias("y")), "hashes"
    )
    blocks = hashed.groupBy("conv", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("n").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(
        F.col("conv").alias("_conv"), F.col("block").alias("_block"),
        F.coalesce(F.bit_xor("x").over(earlier), F.lit(0)).alias("bx"), F.coalesce(F.bit_xor("y").over(earlier), F.lit(0)).alias("by"),
    )
    upto = Window.partitionBy("conv", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = (
        hashed.withColumn("px", F.bit_xor("x").over(upto)).withColumn("py", F.bit_xor("y").over(upto))
        .join(before, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
        .select("conv", "n", F.col("px").bitwiseXOR(F.col("bx")).alias("x"), F.col("py").bitwiseXOR(F.col("by")).alias("y"))
    )
    whole = blocks.groupBy("conv").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("n").alias("n"))
    ends = whole.select(F.col("conv").alias("_conv"), F.col("n").alias("turns"))
    # Prefixes of longer conversations, each once however many share it.
    shorter = prefixes.join(ends, F.col("conv").eqNullSafe(F.col("_conv"))).where("n < turns").select("n", "x", "y").distinct()
    least = whole.groupBy("n", "x", "y").agg(F.min("conv").alias("conv"))
    return least.join(shorter, ["n", "x", "y"], "left_anti").select("conv", F.col("n").alias("turns"))


def render(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv, turns, text`` of the conversations ``convs``: each turn between its role's mark and an end mark.

    A conversation becomes one text, which has to fit in one row.
    """
    piece = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    chosen = convs.select(F.col("conv").alias("_conv"), "turns")
    return (
        rows.join(chosen, F.col("conv").eqNullSafe(F.col("_conv")))
        .groupBy("conv", "turns").agg(F.sort_array(F.collect_list(F.struct("n", piece.alias("piece")))).alias("pieces"))
        .select("conv", "turns", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"))
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, turns, text``: every conversation of ``conv_id, turn, role, text`` that no longer one begins with, rendered.

    Rows without an id are one conversation. Other columns are not looked at.
    """
    rows = stage(numbered(turns), "numbered")
    return render(rows, maximal(rows)).withColumnRenamed("conv", "conv_id")
