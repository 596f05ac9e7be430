"""Logged conversations: cumulative snapshots collapsed to the longest, then rendered.

A log may hold a conversation again after every turn. Each turn has a 128-bit hash of its number, role and
text; the hashes of all turns up to one, combined, name that prefix. A conversation whose whole
hash is a prefix of a longer one is dropped by an anti-join; of equal ones the smallest number stays.

Prefixes are combined in two steps, within blocks of turns and then over the blocks, so a
conversation with very many turns is spread over tasks. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logspark.llm.common import only, saved

#: Turn numbers of a block; a rendered row holds the turns of one.
BLOCK = 1024


def _hash(seed: str) -> Column:
    """Null and empty differ, and so do the columns."""
    return F.xxhash64(
        F.lit(seed), F.col("turn").isNull(), "turn", F.col("role").isNull(), "role", F.col("text").isNull(), "text"
    )


def _turns(conversations: DataFrame) -> DataFrame:
    turns = only(conversations, conv_id="long", turn="long", role="string", text="string").distinct()
    # Turns without a number come before all others.
    return turns.withColumn("part", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1)).cast("long"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that are neither a prefix of a longer one nor a repeat of one with a smaller number."""
    hashed = turns.select("conv_id", "part", "turn", _hash("a").alias("a"), _hash("b").alias("b"))
    one = F.lit(1).cast("long")
    blocks = hashed.groupBy("conv_id", "part").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.count("*").alias("n")
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = saved(blocks.select(
        "conv_id", "part", *[F.coalesce(f(c).over(before), zero).alias(f"{c}0") for c, f in (("a", F.bit_xor), ("b", F.bit_xor), ("n", F.sum))],
        F.bit_xor("a").over(whole).alias("all_a"), F.bit_xor("b").over(whole).alias("all_b"), F.sum("n").over(whole).alias("all_n"),
    ), "blocks")
    upto = Window.partitionBy("conv_id", "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, 0)
    running = hashed.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.bit_xor("a").over(upto).alias("a"),
        F.bit_xor("b").over(upto).alias("b"), F.sum(one).over(upto).alias("n"),
    )
    prefixes = running.join(blocks, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("p") == F.col("part"))).select(
        F.col("a").bitwiseXOR(F.col("a0")).alias("all_a"), F.col("b").bitwiseXOR(F.col("b0")).alias("all_b"),
        (F.col("n") + F.col("n0")).alias("prefix_n"), "all_n",
    ).where("prefix_n < all_n").select("all_a", "all_b", F.col("prefix_n").alias("all_n")).distinct()
    logged = blocks.groupBy("all_a", "all_b", "all_n").agg(F.min("conv_id").alias("conv_id"))
    return logged.join(prefixes, ["all_a", "all_b", "all_n"], "left_anti").select("conv_id")


def render(turn: Column) -> Column:
    """One turn between markers. Markers inside its role or text lose their bars; a role is one line."""
    role, text = (
        F.regexp_replace(F.coalesce(turn[name], F.lit(none)), r"<\|(im_start|im_end)\|>", "<$1>")
        for name, none in (("role", "unknown"), ("text", ""))
    )
    return F.concat(F.lit("<|im_start|>"), F.translate(role, "\r\n", "  "), F.lit("\n"), text, F.lit("<|im_end|>"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per kept conversation and ``part`` (BLOCK turn numbers): ``n_turns`` and the rendered ``text``.

    Repeated rows count once; turns with one number are ordered by role and text. Rows without
    conv_id are one conversation, rows without turn come first (part -1). Extra columns are dropped.
    """
    turns = _turns(conversations)
    kept = maximal_conversations(turns).select(F.col("conv_id").alias("kept_id"))
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return (
        turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
        .groupBy("conv_id", "part").agg(rows.alias("rows"))
        .select("conv_id", "part", F.size("rows").cast("long").alias("n_turns"), F.array_join(F.transform("rows", render), "\n").alias("text"))
    )
