"""Chat formatting for preference data, in DataFrame functions only.

Two conversations of a pair, the chosen and the rejected one, share a longest
common prefix of turns. It is rendered once as the prompt; what follows it on
either side is rendered as a completion, with the spans that carry loss: the
texts of the assistant's turns and the marks that close them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

SIDES = ("chosen", "rejected")


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Turns with ``pair_id`` and ``side`` for data without marked preferences.

    Conversations 2k and 2k + 1 make pair k, the even one chosen, negative ones too.
    Turns without a conversation belong to no pair and are left out.
    """
    conv = F.col("conv_id").cast("long")
    return turns.where(conv.isNotNull()).select(
        F.shiftright(conv, 1).alias("pair_id"),
        F.when(conv.bitwiseAND(F.lit(1)) == 0, F.lit(SIDES[0])).otherwise(F.lit(SIDES[1])).alias("side"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )


def swapped_pairs(turns: DataFrame) -> DataFrame:
    """Turns with ``pair_id`` and ``side``: a conversation, and itself with another's last answer.

    Pair k is chosen conversation k; in the rejected one the assistant's last turn has
    the text of the last one of conversation k + 1. Of turns with one number the larger
    text is last, and copies of that turn change alike. Conversations where either has
    no turn of the assistant make no pair. One row per conversation is joined.
    """
    own = turns.select(
        F.col("conv_id").cast("long").alias("pair_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ).where(F.col("pair_id").isNotNull())
    answers = own.where(F.col("role") == LOSS_ROLE)
    last = answers.groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("_last"))
    given = last.select(
        F.try_subtract("pair_id", F.lit(1).cast("long")).alias("pair_id"),
        F.col("_last.text").alias("_other"),
    )
    both = own.join(last.join(given, "pair_id"), "pair_id")
    is_last = (
        (F.col("role") == LOSS_ROLE)
        & F.col("turn").eqNullSafe(F.col("_last.turn"))
        & F.col("text").eqNullSafe(F.col("_last.text"))
    )
    swapped = F.when(is_last, F.col("_other")).otherwise(F.col("text"))
    sides = F.array(
        F.struct(F.lit(SIDES[0]).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(SIDES[1]).alias("side"), swapped.alias("text")),
    )
    return both.select("pair_id", "turn", "role", F.inline(sides))


def _plain(text: Column) -> Column:
    """Text in which nothing reads as a mark of the template."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _heading(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit("\n"))


def _rendered(turn: Column) -> Column:
    return F.concat(_heading(turn), _plain(turn["text"]), F.lit(CLOSE + "\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _loss_spans(turns: Column) -> Column:
    """``start:end`` of every span with loss in the rendered turns, comma-joined."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_heading(turn))
        end = start + F.length(_plain(turn["text"])) + len(CLOSE)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        spans = F.when(
            turn["role"] == LOSS_ROLE, F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        return F.struct((end + 1).cast("int").alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, zero, add, lambda s: s["spans"]), ",")


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair from turns with ``pair_id``, ``side``, ``turn``, ``role``, ``text``.

    Turns are ordered by number (null first), then role and text, so ties and
    repeated rows have a fixed order. A turn is common if role and text are equal
    on both sides; null equals null. Null texts and roles render as empty. A
    missing side has no turns: its completion is null and the prompt is empty.
    Other columns are not read. A pair becomes one row, so its turns meet in one
    task; nothing larger than a pair does.
    """
    turn = F.struct("turn", "role", "text")
    ordered = turns.groupBy("pair_id").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("side") == side, turn))).alias(f"{side}_sorted")
            for side in SIDES
        ]
    )
    bare = ordered.select(
        "pair_id",
        *[
            F.transform(
                f"{side}_sorted",
                lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
            ).alias(side)
            for side in SIDES
        ],
    )
    equal = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    first_other = F.array_position(equal, F.lit(False))
    common = F.when(first_other > 0, first_other - 1).otherwise(F.size(equal)).cast("int")
    split = bare.withColumn("n_common", common)
    sides = []
    for side in SIDES:
        left = F.size(side) - F.col("n_common")
        rest = F.slice(side, F.col("n_common") + 1, F.greatest(left, F.lit(0)))
        present = F.size(side) > 0
        sides += [
            F.when(present, _text(rest)).alias(side),
            F.when(present, _loss_spans(rest)).alias(f"{side}_loss"),
            F.when(present, F.greatest(left, F.lit(0)).cast("long")).alias(f"n_{side}_turns"),
        ]
    return split.select(
        "pair_id",
        F.col("n_common").cast("long").alias("n_prompt_turns"),
        _text(F.slice("chosen", 1, F.col("n_common"))).alias("prompt"),
        *sides,
    )
