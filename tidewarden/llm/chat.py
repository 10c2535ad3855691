"""Chat formatting: logged snapshots of one conversation are collapsed, the longest is rendered.

A chat logged after each turn leaves conversations that are prefixes of longer ones. A rolling hash
of each prefix of turns (their place, role and text) is kept as two lanes of 64 bits; a conversation
goes when its whole hash is among the proper prefixes of another (an anti-join on distinct keys), and
of equal conversations the one with the smallest id stays.

A conversation is ordered in blocks of turn numbers, so that no task sorts or renders a whole one:
its turns are ranked and hashed block by block, with the sums of the earlier blocks added, and a
block is rendered as one piece. Pieces of a conversation joined in order are its text.

A null role or text is the empty one; a null turn comes last; a null id is a conversation of its own.
Repeated rows are one turn; different rows of the same turn follow each other by role, then text. An
empty table gives an empty result. Columns other than the four named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.common import written

#: Turn numbers in a block, and so the most turns that are rendered together.
BLOCK = 64


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str,
           block: int) -> DataFrame:
    """Distinct turns, dealt out by conversation and block, ranked inside the block."""
    dealt = rows.select(
        F.col(conv_id).isNull().alias("no_id"),
        F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("conv"),
        F.coalesce(F.floor(F.col(turn) / block), F.lit(2 ** 62)).cast("long").alias("block"),
        F.col(turn).cast("double").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).repartition("no_id", "conv", "block")
    distinct = dealt.groupBy("no_id", "conv", "block", "turn", "role", "text").agg(
        F.count("*").alias("logged"))
    place = Window.partitionBy("no_id", "conv", "block").orderBy(
        F.col("turn").asc_nulls_last(), "role", "text")
    return distinct.withColumn("place", F.row_number().over(place))


def _before(total: Column) -> Column:
    earlier = Window.partitionBy("no_id", "conv").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    return F.coalesce(total.over(earlier), F.lit(0).cast("long"))


def prefix_hashes(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text", block: int = BLOCK
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns with their rank; blocks with their start; the rolling hash after each turn."""
    keys = ["no_id", "conv", "block"]
    turns = _turns(rows, conv_id, turn, role, text, block)
    whole = Window.partitionBy("no_id", "conv")
    blocks = turns.groupBy(*keys).agg(F.max("place").cast("long").alias("size")).select(
        *keys, "size", _before(F.sum("size")).alias("start"),
        F.sum("size").over(whole).alias("n_turns"))
    ranked = turns.join(blocks, keys).withColumn("rank", F.col("start") + F.col("place"))
    hashed = ranked.select(
        *keys, "rank", "n_turns", F.xxhash64("rank", "role", "text").alias("one"),
        F.xxhash64("text", F.lit("|"), "role", "rank").alias("two"))
    sums = hashed.groupBy(*keys).agg(F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    carried = sums.select(*keys, _before(F.bit_xor("one")).alias("one_before"),
                          _before(F.bit_xor("two")).alias("two_before"))
    rolling = Window.partitionBy(*keys).orderBy("rank")
    prefixes = hashed.join(carried, keys).select(
        "no_id", "conv", "rank", "n_turns",
        F.col("one_before").bitwiseXOR(F.bit_xor("one").over(rolling)).alias("one"),
        F.col("two_before").bitwiseXOR(F.bit_xor("two").over(rolling)).alias("two"))
    return ranked, blocks, prefixes


def maximal(prefixes: DataFrame) -> DataFrame:
    """The conversations that no other one continues; of equal ones the smallest id, and how many
    were equal. Ids that are numbers are compared as numbers."""
    wholes = prefixes.filter("rank = n_turns").groupBy("n_turns", "one", "two").agg(
        F.min(F.struct("no_id", F.expr("try_cast(conv AS double)").alias("number"), "conv"))
        .alias("first"), F.count("*").alias("equal"))
    proper = prefixes.filter("rank < n_turns").select(
        F.col("rank").alias("n_turns"), "one", "two").distinct()
    return wholes.join(proper, ["n_turns", "one", "two"], "left_anti").select(
        "first.no_id", "first.conv", "equal")


def collapse_snapshots(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text", start: str = "<|im_start|>",
                       end: str = "<|im_end|>", block: int = BLOCK) -> DataFrame:
    """Columns conv_id, n_turns, equal, piece (from 0), turns and text; a row for each piece."""
    ranked, blocks, prefixes = prefix_hashes(rows, conv_id, turn, role, text, block)
    prefixes = written(prefixes, "prefixes")  # three consumers
    numbered = Window.partitionBy("no_id", "conv").orderBy("block")
    kept = blocks.withColumn("piece", F.row_number().over(numbered) - 1).join(
        maximal(prefixes), ["no_id", "conv"]).select("no_id", "conv", "block", "piece", "equal")
    rendered = F.concat(F.lit(start), F.col("role"), F.lit("\n"), F.col("text"), F.lit(end),
                        F.lit("\n"))
    pieces = ranked.join(kept, ["no_id", "conv", "block"]).groupBy("no_id", "conv", "block").agg(
        F.max("n_turns").alias("n_turns"), F.max("equal").alias("equal"),
        F.max("piece").alias("piece"), F.count("*").alias("turns"),
        F.sort_array(F.collect_list(F.struct("rank", rendered.alias("text")))).alias("parts"))
    kind = rows.schema[conv_id].dataType
    return pieces.select(
        F.when(~F.col("no_id"), F.col("conv").cast(kind)).alias("conv_id"), "n_turns", "equal",
        "piece", "turns", F.array_join(F.col("parts.text"), "").alias("text"))
