"""Preference data: shared prompt and masked completions of paired conversations.

The conversations of a pair are compared turn by turn. Turns before the first one at
which they differ are the longest common prefix and become the prompt, rendered once; what
follows is each side's completion. The result has a row per rendered turn, in the order of
``part`` and ``turn``, so a conversation of any length stays spread over tasks. ``loss``
marks the text a model learns from: turns of the assistant in a completion.

Two turns are equal when role and text are, a null being the empty text. A conversation
that goes on where the other has ended differs there. Rows without a conversation
id belong to none and are left out; a null turn comes first. Repeated rows count once; differing rows
of one turn all belong to it. Other columns are not read and an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def turns_of(conversations: DataFrame) -> DataFrame:
    """Distinct turns: conv_id, turn, role, text."""
    return (
        conversations.where("conv_id IS NOT NULL")
        .select(
            "conv_id",
            F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
    )


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """Pairs of conversations that open alike: pair_id, chosen_id, rejected_id.

    The smallest id of each opening is chosen over every other one, which makes no more
    pairs than there are conversations, however many share an opening. A conversation that opens like no
    other is paired by id: an odd one with the one before it, if there is one.
    """
    openings = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("opening"))
    keyed = openings.select("conv_id", F.sha2(F.to_json("opening"), 256).alias("opening"))
    first = keyed.groupBy("opening").agg(
        F.min("conv_id").alias("chosen_id"), F.count(F.lit(1)).alias("n")
    )
    alone = (F.col("n") == 1) & (F.col("conv_id") % 2 == 1)
    chosen = F.when(alone, F.col("conv_id") - 1).otherwise(F.col("chosen_id"))
    there = keyed.select(F.col("conv_id").alias("chosen_id"))
    return (
        keyed.join(first, "opening")
        .select("conv_id", chosen.alias("chosen_id"))
        .where("conv_id <> chosen_id")
        .join(there, "chosen_id", "left_semi")
        .select(F.col("conv_id").alias("pair_id"), "chosen_id", F.col("conv_id").alias("rejected_id"))
    )


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def preference_segments(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, chosen_id, rejected_id, part, turn, role, rendered, loss."""

    def side(name: str) -> DataFrame:
        return pairs.join(turns, F.col(f"{name}_id") == F.col("conv_id")).select(
            "pair_id", "chosen_id", "rejected_id", "turn", "role", "text", F.lit(name).alias("side")
        )

    # Equal turns of both sides meet in one row of this aggregate.
    met = (
        side(CHOSEN)
        .unionByName(side(REJECTED))
        .groupBy("pair_id", "chosen_id", "rejected_id", "turn", "role", "text")
        .agg(
            F.max(F.col("side") == CHOSEN).alias("in_chosen"),
            F.max(F.col("side") == REJECTED).alias("in_rejected"),
        )
    )
    parting = (
        met.where("NOT (in_chosen AND in_rejected)")
        .groupBy("pair_id")
        .agg(F.min("turn").alias("parts_at"))
    )
    shared = F.col("parts_at").isNull() | (F.col("turn") < F.col("parts_at"))
    parts = F.when(shared, F.array(F.lit(PROMPT))).otherwise(
        F.filter(
            F.array(
                F.when(F.col("in_chosen"), F.lit(CHOSEN)), F.when(F.col("in_rejected"), F.lit(REJECTED))
            ),
            lambda part: part.isNotNull(),
        )
    )
    return (
        met.join(parting, "pair_id", "left")
        .select("*", F.explode(parts).alias("part"))
        .select(
            "pair_id",
            "chosen_id",
            "rejected_id",
            "part",
            "turn",
            "role",
            rendered(F.col("role"), F.col("text")).alias("rendered"),
            ((F.col("role") == "assistant") & (F.col("part") != PROMPT)).alias("loss"),
        )
    )
