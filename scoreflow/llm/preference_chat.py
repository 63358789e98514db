"""Chat formatting: preference pairs.

A pair is two conversations, chosen and rejected. Turns are compared by
position; the longest common prefix of turns (same role, same text) is
rendered once as the prompt, and what each side adds is its completion, with a
loss mask over the assistant's words.

The prefix needs no list of turns: chosen and rejected turns meet in one join
on (pair, position), and the first position that differs is a grouped minimum.
Rendering gathers the turns of one conversation, which is one output text.

Layout of a rendered turn: `<|role|>` newline, text, newline. A completion's
mask lists the half-open character ranges of assistant texts with their
closing newline, as `start:end`, comma-joined, relative to the completion.

Defined results: a turn with a null conv_id is ignored; null turn numbers sort
first and ties keep the order of (role, text); several identical rows are
several turns; a null role renders as `unknown`, a null text as empty; a pair
with one side missing has an empty prompt and an empty completion for the
missing side; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def _turns(conversations: DataFrame) -> DataFrame:
    """(pair_id, side, at, role, text) with positions counted from 0."""
    c = conversations.select(
        "pair_id",
        "side",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = "over (partition by pair_id, side order by turn nulls first, role, text)"
    return c.selectExpr("pair_id", "side", f"row_number() {order} - 1 as at", "role", "text")


def preference_pairs(conversations: DataFrame, mask_role: str = "assistant") -> DataFrame:
    """From rows (pair_id, side, turn, role, text), side `chosen` or
    `rejected`: one row per pair with the number of common turns, the prompt,
    both completions and their masks."""
    turns = _turns(conversations.where(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected")))
    # Both sides of a position meet in one row of a grouped join.
    both = turns.groupBy("pair_id", "at").agg(
        *[F.max(F.when(F.col("side") == s, F.struct("role", "text"))).alias(s) for s in ("chosen", "rejected")]
    )
    same = both["chosen"].eqNullSafe(both["rejected"])
    prefix = both.groupBy("pair_id").agg(
        F.min(F.when(~same, F.col("at"))).alias("differs"), F.count(F.lit(1)).alias("positions")
    )
    prefix = prefix.select("pair_id", F.coalesce("differs", "positions").cast("long").alias("n_common"))
    piece = F.struct("at", render(F.col("role"), F.col("text")).alias("out"), "role", F.length("text").alias("len"))
    sides = turns.groupBy("pair_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == s, piece))).alias(s) for s in ("chosen", "rejected")]
    )
    out = sides.join(prefix, "pair_id")

    def join_text(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p: p["out"]), "")

    def completion(side: str) -> Column:
        return F.filter(F.col(side), lambda p: p["at"] >= F.col("n_common"))

    out = out.select(
        "pair_id",
        "n_common",
        F.size("chosen").cast("long").alias("n_chosen"),
        F.size("rejected").cast("long").alias("n_rejected"),
        join_text(F.filter("chosen", lambda p: p["at"] < F.col("n_common"))).alias("prompt"),
        completion("chosen").alias("chosen_parts"),
        completion("rejected").alias("rejected_parts"),
    )

    def mask(parts: str) -> Column:
        # One pass: running offset and the ranges of the masked role.
        start = F.struct(F.lit(0).alias("to"), F.array().cast("array<string>").alias("ranges"))

        def step(acc, p):
            end = (acc["to"] + F.length(p["out"])).alias("to")
            begin = acc["to"] + F.length(p["out"]) - p["len"] - 1
            mine = F.concat_ws(":", begin.cast("string"), (acc["to"] + F.length(p["out"])).cast("string"))
            ranges = F.when(p["role"] == mask_role, F.concat(acc["ranges"], F.array(mine))).otherwise(acc["ranges"])
            return F.struct(end, ranges.alias("ranges"))

        return F.array_join(F.aggregate(parts, start, step, lambda acc: acc["ranges"]), ",")

    return out.select(
        "pair_id",
        "n_common",
        "n_chosen",
        "n_rejected",
        "prompt",
        join_text(F.col("chosen_parts")).alias("chosen"),
        join_text(F.col("rejected_parts")).alias("rejected"),
        mask("chosen_parts").alias("chosen_mask"),
        mask("rejected_parts").alias("rejected_mask"),
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs conversation 2k (chosen) with 2k + 1 (rejected), pair_id k."""
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"),
        F.when(F.pmod("conv_id", F.lit(2)) == 0, F.lit("chosen")).otherwise(F.lit("rejected")).alias("side"),
        "turn",
        "role",
        "text",
    )
