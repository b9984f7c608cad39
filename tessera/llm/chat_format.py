"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation (each role but ``system``) the dialogue is rendered once with that speaker as
the assistant, all others as named users and system turns as they are. A turn is a segment of the rendered text; its
offsets come from running sums over the whole conversation, and the loss mask covers the assistant's words and end
mark only. Segments, not one string per conversation, are the result, so a conversation of any length is spread over
tasks; :func:`assembled` joins them to texts of bounded length. The result has a row per turn and participant: it grows with their
product within a conversation.

Marks belong to the format alone: in texts and names ``<|`` is written ``< |``, and control characters of a name in a turn's head
(line breaks above all) are one space, so no text or name can forge a turn.

Defined results: a null text is an empty turn; a null role is the participant ``unknown``; turns that share a number
are ordered by role and text; a conversation of system turns only has no participant and no rendering; a null conv_id
is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ordered, running_sum

START, END = "<|im_start|>", "<|im_end|>\n"


def apart(text) -> F.Column:
    """``<|`` as ``< |``: no text can hold a start or end mark, so none can pass for a turn of another speaker."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id, turn, role, text. Returns conv_id, perspective, turn, role, segment, char_start, char_end,
    target_start, target_end (offsets in the rendered dialogue; null where nothing is learnt)."""
    base = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), apart(F.coalesce("text", F.lit(""))).alias("text"))
    speakers = base.where("role <> 'system'").select(F.col("conv_id").alias("_c"), F.col("role").alias("perspective")).distinct()
    rows = base.join(speakers, base["conv_id"].eqNullSafe(speakers["_c"])).drop("_c")
    mine = F.col("role") == F.col("perspective")
    head = F.when(F.col("role") == "system", F.lit("system")).when(mine, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), apart(F.regexp_replace("role", "[\\x00-\\x1F]+", " "))))
    rows = rows.withColumn("_head", F.concat(F.lit(START), head, F.lit("\n"))).withColumn("segment", F.concat("_head", "text", F.lit(END)))
    rows = rows.withColumn("_len", F.length("segment").cast("long")).withColumn("_skip", F.length("_head").cast("long")).withColumn("_mine", mine)
    keys = ["conv_id", "perspective"]
    srt = ordered(rows.drop("_head"), [F.col("conv_id").asc_nulls_last(), "perspective", "turn", "role", "text"])
    out = running_sum(srt, "_len", "char_end", keys)
    start = F.col("char_end") - F.col("_len")
    return out.select(*keys, "turn", "role", "segment", start.alias("char_start"), "char_end",
                      F.when(F.col("_mine"), start + F.col("_skip")).alias("target_start"),
                      F.when(F.col("_mine"), F.col("char_end")).alias("target_end"))


def assembled(segments: DataFrame, part_chars: int = 1_000_000) -> DataFrame:
    """Rendered texts and masks, cut between turns into parts of about ``part_chars`` characters."""
    part = F.floor(F.col("char_start") / part_chars).alias("part")
    rows = segments.groupBy("conv_id", "perspective", part).agg(
        F.min("char_start").alias("offset"), F.array_sort(F.collect_list(F.struct("char_start", "turn", "segment"))).alias("s"),
        F.array_sort(F.collect_list(F.when(F.col("target_start").isNotNull(), F.struct("target_start", "target_end")))).alias("mask"))
    return rows.select("conv_id", "perspective", "part", "offset", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("text"), "mask")
