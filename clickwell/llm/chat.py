"""Chat formatting with cumulative-snapshot collapse (operator 5).

Chat logs often hold a conversation several times, each time with the turns so far.
Every turn gets the rolling hash of the conversation up to it; a conversation whose
whole hash is the prefix hash of a longer one is a snapshot and is dropped by an
anti-join, and of equal conversations the smallest id stays.  What remains is rendered as
one text per conversation in the ChatML layout.

The rolling hash of a prefix is the exclusive or, in two independent 64-bit hashes, of
its turns' hashes, each taken with the turn's position; positions are unique within a
conversation, so equal prefixes and only those agree (but for chance, 1 in 2 ** 128).  It
is a running window aggregate, so a turn costs the same however long the conversation.
Prefix hashes are made distinct before the join: a first turn that a third of all
conversations share is one row after map-side aggregation.

Defined cases: rows that repeat a turn exactly count once; turns are ordered by turn
number (null first), then role, then text; a null role is ``unknown``, a null text is
empty; rows with a null conversation id belong to no conversation and are left out;
``<|`` in a role or text is written ``<\\|``, so no text can forge a turn; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text of every turn, in order."""
    clean = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return clean.withColumn("pos", F.row_number().over(order))


def prefix_hashes(ordered: DataFrame) -> DataFrame:
    """conv_id, pos, h1, h2 (hash of turns 1 to pos) and n (turns of the conversation)."""
    running = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    roll = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "pos", "role", "text")).over(running)
    return ordered.select("conv_id", "pos", roll(1).alias("h1"), roll(2).alias("h2"),
                          F.count("*").over(Window.partitionBy("conv_id")).alias("n"))


def maximal_ids(ordered: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_logged (equal conversations) of the conversations to keep."""
    hashes = prefix_hashes(ordered)
    whole = hashes.filter("pos = n").groupBy("n", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged"))
    inner = hashes.filter("pos < n").select(F.col("pos").cast("long").alias("n"), "h1", "h2").distinct()
    return whole.join(inner, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_logged")


def render(ordered: DataFrame) -> DataFrame:
    """One text per conversation: each turn as START role, line feed, text, END, line feed."""
    part = F.concat(F.lit(START), _safe(F.col("role")), F.lit("\n"), _safe(F.col("text")), F.lit(END + "\n"))
    lists = ordered.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", part.alias("part")))).alias("parts"))
    return lists.select("conv_id", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("rendered"))


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_logged, rendered of every conversation that no other extends."""
    ordered = turns(conversations)
    kept = maximal_ids(ordered)
    return kept.join(render(ordered.join(kept.select("conv_id"), "conv_id", "left_semi")), "conv_id").select(
        "conv_id", "n_turns", "n_logged", "rendered")
