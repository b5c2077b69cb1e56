"""Preference data for chat models: one prompt, two completions.

The prompt is the longest run of turns that the chosen and the rejected conversation begin with alike (role and
text; a null equals a null), rendered once. What follows in each is its completion. A completion comes with the
spans that a model learns from, which are the texts of assistant turns and the marks that end them; the prompt is
masked as a whole, and so are other roles' turns.

A null text is rendered as empty, a null role as ``unknown``, a null conversation as no turns. Marks of the format
inside a text are broken up, so that a text can't open or close a turn. Equal conversations have empty
completions. Pairs with the same id are pairs of their own. Further columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK, BROKEN = "<|im_", "<| im_"
LEARNED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def _role(turn: Column) -> Column:
    return F.replace(F.coalesce(turn["role"], F.lit("unknown")), F.lit(MARK), F.lit(BROKEN))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _role(turn), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit(MARK), F.lit(BROKEN)), F.lit(CLOSE))


def render(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def learned_spans(turns: Column) -> Column:
    """``start, end`` in the rendered turns, in code points, of what a model learns from."""
    nothing = F.lit([]).cast("array<struct<start:int,end:int>>")

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_head(turn))
        end = start + F.length(_body(turn))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == LEARNED, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), step, lambda s: s["spans"])


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns both begin with."""
    same = F.zip_with(chosen, rejected, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differs = F.array_position(F.transform(same, lambda s: F.coalesce(s, F.lit(False))), False)
    shorter = F.least(F.size(chosen), F.size(rejected))
    return F.when(differs > 0, F.least(differs - 1, shorter)).otherwise(shorter).cast("int")


def preferences(pairs: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected`` (turns) -> ``pair_id, n_common, prompt``, completions and their learned spans."""
    sides = [F.coalesce(F.col(side), F.array().cast(TURNS)).cast(TURNS).alias(side) for side in ("chosen", "rejected")]
    turns = pairs.select("pair_id", *sides).select("*", common_turns(F.col("chosen"), F.col("rejected")).alias("n_common"))

    def after(side: str) -> Column:
        return F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side) - F.col("n_common"), F.lit(0)))

    return turns.select(
        "pair_id", "n_common", render(F.slice("chosen", 1, F.col("n_common"))).alias("prompt"),
        *[render(after(side)).alias(side) for side in ("chosen", "rejected")],
        *[learned_spans(after(side)).alias(f"{side}_spans") for side in ("chosen", "rejected")],
    )


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` from a row per turn, in order of turn; repeated rows count once, rows without an id not at all.

    Turns with the same number follow by role and text.
    """
    turn = F.struct("turn", "role", "text")
    return rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(
        F.transform(
            F.array_sort(F.collect_set(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns")
    )


def cut_short(turns: Column) -> Column:
    """The turns with the last assistant turn broken off half way: a completion worse than the whole one."""
    learned = F.transform(turns, lambda t: F.coalesce(t["role"] == LEARNED, F.lit(False)))
    last = F.size(turns) - F.array_position(F.reverse(learned), True)

    def step(turn: Column, place: Column) -> Column:
        text = F.coalesce(turn["text"], F.lit(""))
        half = F.left(text, F.floor(F.length(text) / 2))
        return F.struct(turn["role"].alias("role"), F.when(place == last, half).otherwise(turn["text"]).alias("text"))

    return F.transform(turns, step)


def broken_off_pairs(rows: DataFrame) -> DataFrame:
    """A pair of each conversation with an assistant turn and itself with the last of them broken off."""
    whole = conversations(rows).where(F.exists("turns", lambda t: t["role"] == LEARNED))
    return whole.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), cut_short(F.col("turns")).alias("rejected"))
