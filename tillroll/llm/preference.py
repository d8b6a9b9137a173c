"""Preference pairs: the turns two conversations share as prompt, the rest as completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written. The part before and after its text is not trained on.
OPENING, MIDDLE, CLOSING = "<|", "|>\n", "<|end|>\n"
#: The role whose turns are trained on, with their closing mark.
TRAINED = "assistant"


def adjacent_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id): conversations 2k and 2k + 1; k is the pair.

    The even one is the chosen one. Where one of the two does not occur its id is null.
    """
    ids = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    even = F.pmod("id", F.lit(2)) == 0
    return ids.groupBy(F.floor(F.col("id") / 2).alias("pair_id")).agg(
        F.max(F.when(even, F.col("id"))).alias("chosen_id"), F.max(F.when(~even, F.col("id"))).alias("rejected_id")
    )


def _text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPENING), role, F.lit(MIDDLE), text, F.lit(CLOSING))


def formatted(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair with its prompt and its two masked completions.

    ``turns`` has (conv_id, turn, role, text), ``pairs`` (pair_id, chosen_id, rejected_id).
    The result has pair_id, both ids, n_shared (turns of the longest common prefix, equal
    in role and text), prompt (those turns, rendered once), and for each side its
    completion (the other turns) and mask: [start, end) positions in characters of what is
    trained on, the text and closing mark of the assistant's turns.

    Turns count in the order of ``turn``, then role and text; equal rows are one turn each.
    Null roles and texts are empty ones, a null turn sorts first. A side that is missing
    or has no turns is an empty conversation; so is the completion of one that the other
    goes on from. Other columns are ignored. An empty table gives no rows.

    A pair's turns come together in one row, as its rendered conversations do. What is
    shuffled for it are the turns alone, once.
    """
    sides = pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("id")),
                F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("id")),
            )
        ),
    )
    said = turns.select(
        F.col("conv_id").cast("bigint").alias("id"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    rows = sides.join(said, "id", "left").groupBy("pair_id").agg(
        F.max("chosen_id").alias("chosen_id"),
        F.max("rejected_id").alias("rejected_id"),
        *[
            F.sort_array(F.collect_list(F.when((F.col("side") == side) & F.col("said").isNotNull(), F.col("said")))).alias(name)
            for side, name in enumerate(("chosen_turns", "rejected_turns"))
        ],
    )
    same = F.zip_with(
        "chosen_turns", "rejected_turns", lambda a, b: (a["role"] == b["role"]).eqNullSafe(True) & (a["text"] == b["text"]).eqNullSafe(True)
    )
    rows = rows.withColumn("same", same)
    first_other = F.array_position("same", F.lit(False))  # from 1; 0: none
    shared = F.when(first_other > 0, first_other - 1).otherwise(F.size("same")).cast("bigint")
    rows = rows.withColumn("n_shared", shared).drop("same")
    n = F.col("n_shared").cast("int")
    prompt = F.array_join(F.transform(F.slice("chosen_turns", F.lit(1), n), lambda t: _text(t["role"], t["text"])), "")
    rows = rows.withColumn("prompt", prompt)
    for side in ("chosen", "rejected"):
        rows = rows.withColumn(side, F.slice(f"{side}_turns", n + 1, F.size(f"{side}_turns"))).drop(f"{side}_turns")
        rows = _rendered(rows, side)
    return rows.select(
        "pair_id", "chosen_id", "rejected_id", "n_shared", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"
    )


def _rendered(rows: DataFrame, side: str) -> DataFrame:
    """Turns an array of turns into its text and the mask beside it."""
    turns = F.col(side)
    ahead = len(OPENING) + len(MIDDLE)
    # Where each turn starts, as running totals of the lengths before it.
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + ahead + F.length(turn["role"])
        end = start + F.length(turn["text"]) + len(CLOSING)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == TRAINED, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    mask = F.aggregate(turns, zero, step, lambda state: state["spans"])
    text = F.array_join(F.transform(turns, lambda t: _text(t["role"], t["text"])), "")
    return rows.withColumns({f"{side}_mask": mask, f"{side}_text": text}).drop(side).withColumnRenamed(f"{side}_text", side)


def preference_rows(turns: DataFrame) -> DataFrame:
    """:func:`formatted` over neighbouring conversations, masks as text ``start-end;...``."""
    rows = formatted(turns, adjacent_pairs(turns))
    spelled = {
        f"{side}_mask": F.array_join(
            F.transform(f"{side}_mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ";"
        )
        for side in ("chosen", "rejected")
    }
    return rows.withColumns(spelled)
