"""Chat formatting of logged conversations, one rendering for each maximal conversation.

Logs hold snapshots: a conversation is written again each time it grows. Every turn has a
rolling hash of the conversation up to it (turn hashes keyed by their place, combined with
xor, 128 bits). A conversation whose last hash is an inner hash of another one is a prefix
of it and leaves by an anti-join; of equal conversations the smallest conv_id stays. Only
the survivors' texts are brought together and rendered.

Hashes are combined per conversation before anything is compared, and the sets of inner and
last hashes are made distinct with map-side combine, so a first turn or a conversation that a
third of all rows share costs one row per task.

Defined cases: turns are ordered by turn (nulls first), ties by a hash of role and text; a null role or text is
the empty string. Fully repeated rows of a conversation are one turn. Rows without conv_id
are no conversation of each other: each is one of its own, keyed by its content, and never
named; equal ones are one. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONV = ("conv_id", "lone")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, lone (hash of a row without conv_id, else 0), turn, role, text, each row once."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    held = conversations.select("conv_id", "turn", role, text)
    return held.select("conv_id", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
                       .otherwise(0).alias("lone"), "turn", "role", "text")


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """One row per turn: conversation, at (from 1), p1 and p2 of the turns up to it."""
    said = rows.select(*CONV, "turn", F.xxhash64("role", "text").alias("t1"),
                       F.xxhash64(F.lit(7), "role", "text").alias("t2")).distinct()
    order = Window.partitionBy(*CONV).orderBy("turn", "t1", "t2")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = said.withColumn("at", F.row_number().over(order))
    return placed.select(
        *CONV, "at", F.bit_xor(F.xxhash64("at", "t1", "t2")).over(so_far).alias("p1"),
        F.bit_xor(F.xxhash64(F.lit(7), "at", "t1", "t2")).over(so_far).alias("p2"))


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, lone, n_turns of the conversations that neither prefix nor repeat another one."""
    inner = prefix_hashes(turns(conversations))
    last = inner.groupBy(*CONV).agg(F.max(F.struct("at", "p1", "p2")).alias("whole")) \
        .select(*CONV, "whole.*")
    once = last.groupBy("at", "p1", "p2").agg(F.min(F.struct(F.col("conv_id").isNull(), *CONV)).alias("c"))
    once = once.select("at", "p1", "p2", *[F.col(f"c.{c}").alias(c) for c in CONV])
    # a hash at the place of a conversation's end, seen in a longer one
    ends = last.select(*CONV, F.col("at").alias("n_turns"))
    longer = inner.join(ends, inner["conv_id"].eqNullSafe(ends["conv_id"]) & (inner["lone"] == ends["lone"])) \
        .filter(F.col("at") < F.col("n_turns")).select("at", "p1", "p2").distinct()
    return once.join(longer, ["at", "p1", "p2"], "left_anti").select(*CONV, F.col("at").alias("n_turns"))


def rendered(message: Column) -> Column:
    return F.concat(F.lit(OPEN), message["role"], F.lit("\n"), message["text"], F.lit(f"{CLOSE}\n"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, rendered of each maximal conversation."""
    kept, rows = maximal(conversations), turns(conversations)
    own = rows.join(kept, rows["conv_id"].eqNullSafe(kept["conv_id"]) & (rows["lone"] == kept["lone"])) \
        .select(rows["conv_id"], rows["lone"], "n_turns", "turn", "role", "text")
    messages = own.groupBy(*CONV, "n_turns").agg(F.array_sort(F.collect_set(F.struct(
        "turn", F.xxhash64("role", "text").alias("t1"), "role", "text"))).alias("m"))
    return messages.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"),
                           F.array_join(F.transform("m", rendered), "").alias("rendered"))
