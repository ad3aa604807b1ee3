"""Preference formatting of conversation pairs (DataFrame functions only).

A pair is a chosen and a rejected conversation.  Their longest common prefix of turns
(same role and text) is rendered once as the prompt; what follows is
rendered as two completions, each a list of segments with a mask that is true for
what a model should be trained on (turns of the trained role).

Each conversation is gathered into one array of turns once; pairs carry ids only and
join the arrays, so a conversation that is in thousands of pairs is a skewed join key
that AQE splits, never a group.

Defined cases: rows without a conversation id belong to no conversation; a null role
or text counts as empty; ids are of any type that can be ordered; turns are ordered by (turn, role, text), nulls first, and
repeated rows stay; a conversation without partner gives a row whose rejected side
is null and whose prompt ends before its first turn of the trained role; equal
conversations give two empty completions; an empty table gives no rows; other columns
are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: an ordered array of (role, text) for each conversation."""
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (turns.where(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("conv_id"))
            .agg(F.transform(F.sort_array(F.collect_list(turn)),
                             lambda t: F.struct(t["role"].alias("role"),
                                                t["text"].alias("text"))).alias("turns")))


def pairs_by_opening(convs: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``chosen_id, rejected_id``: among conversations with the same first turn, the one
    with most text of the trained role is chosen (ties: the smallest id) and each other
    one is rejected against it; a conversation alone has a null partner."""
    said = F.aggregate(
        F.filter("turns", lambda t: t["role"] == trained_role), F.lit(0).cast("long"),
        lambda n, t: n + F.length(t["text"]))
    first = F.get("turns", F.lit(0))
    # The role's length in front tells where the role ends.
    opening = F.concat_ws(":", F.length(first["role"]), first["role"], first["text"])
    keyed = convs.select("conv_id", said.alias("said"), F.sha2(opening, 256).alias("opening"))
    best = (keyed.groupBy("opening")
            .agg(F.min_by("conv_id", F.struct((-F.col("said")).alias("less"), "conv_id"))
                 .alias("chosen_id"), F.count("*").alias("n")))
    return (keyed.join(best, "opening")
            .where((F.col("conv_id") != F.col("chosen_id")) | (F.col("n") == 1))
            .select("chosen_id", F.when(F.col("n") > 1, F.col("conv_id")).alias("rejected_id")))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _segment), "")


def _segment(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("\n"))


def _after(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def _masked(turns: Column, trained_role: str) -> Column:
    return F.transform(turns, lambda t: F.struct(
        _segment(t).alias("segment"), (t["role"] == trained_role).alias("train")))


def format_preferences(pairs: DataFrame, convs: DataFrame,
                       trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected``; the last two
    are arrays of (segment, train)."""
    chosen = pairs.join(convs.select(F.col("conv_id").alias("chosen_id"),
                                     F.col("turns").alias("a")), "chosen_id")
    rejected = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    # Rows without partner stay out of the join: a null key is a hot key.
    alone = chosen.where("rejected_id is null").withColumn(
        "b", F.lit(None).cast(rejected.schema["b"].dataType))
    joined = (chosen.where("rejected_id is not null").join(rejected, "rejected_id")
              .unionByName(alone))
    both = F.least(F.size("a"), F.size("b"))
    same = F.transform(F.sequence(F.lit(1), both),
                       lambda i: F.element_at("a", i) == F.element_at("b", i))
    common = F.when(both == 0, 0).otherwise(
        F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, both))
    first_trained = F.array_position(F.transform("a", lambda t: t["role"] == trained_role), True)
    before_reply = F.when(first_trained > 0, first_trained - 1).otherwise(F.size("a"))
    cut = joined.withColumn("n_prompt_turns",
                            F.when(F.col("b").isNull(), before_reply).otherwise(common).cast("int"))
    return cut.select(
        "chosen_id", "rejected_id", "n_prompt_turns",
        _render(F.slice("a", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        _masked(_after(F.col("a"), F.col("n_prompt_turns")), trained_role).alias("chosen"),
        _masked(_after(F.col("b"), F.col("n_prompt_turns")), trained_role).alias("rejected"))
