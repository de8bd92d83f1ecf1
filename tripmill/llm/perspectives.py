"""Chat formatting from every participant's point of view, in DataFrame functions only.

For each participant of a conversation the whole dialogue is rendered once: that speaker's
turns as the assistant, everybody else's as named users, with the loss mask on the
assistant's words alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a turn, and what a text's own marks are turned into.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK, HARMLESS = "<|", "< |"

SYSTEM_ROLES = ("system",)


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    system_roles: tuple[str, ...] = SYSTEM_ROLES,
) -> DataFrame:
    """One row per participant and turn of its conversation, ready to be joined in turn order.

    Columns: the conversation and turn columns, ``perspective`` (the participant who is the
    assistant), ``role`` (system, assistant or user), ``name`` (of a user), ``rendered``,
    ``mask_start`` and ``mask_end`` (the characters of ``rendered`` that are trained on,
    null where none are).

    Roles in ``system_roles`` speak as the system in every perspective and have none of
    their own. A turn without a role is an unnamed user. A null text is an empty one; marks
    inside a text are defused, so a text cannot open or close a turn. Repeated turns are
    rendered as often as they occur; a conversation with no participant yields nothing. Null
    conversation ids belong together.

    A conversation is never gathered: turns meet the short list of participants in a
    join on the conversation, whose large side Spark can split.
    """
    said = turns.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.col(role_col).cast("string").alias("_role"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(HARMLESS)).alias("_text"),
    )
    people = (
        said.filter(F.col("_role").isNotNull() & ~F.col("_role").isin(*system_roles))
        .select(F.col("_conv").alias("_of"), F.col("_role").alias("perspective"))
        .distinct()
    )
    speaker = F.col("_role")
    role = (
        F.when(speaker.isin(*system_roles), F.lit("system"))
        .when(speaker == F.col("perspective"), F.lit("assistant"))
        .otherwise(F.lit("user"))
    )
    own = F.col("role") == "assistant"
    shown = F.replace(speaker, F.lit(MARK), F.lit(HARMLESS))
    name = F.when(F.col("role") == "user", F.translate(shown, "\r\n", "  "))
    header = F.concat(
        F.lit(OPEN), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n")
    )
    return (
        said.join(people, said["_conv"].eqNullSafe(people["_of"]))
        .withColumn("role", role)
        .withColumn("name", name)
        .select(
            F.col("_conv").alias(conv_col),
            F.col("_turn").alias(turn_col),
            "perspective",
            "role",
            "name",
            F.concat(header, F.col("_text"), F.lit(CLOSE + "\n")).alias("rendered"),
            F.when(own, F.length(header)).cast("int").alias("mask_start"),
            F.when(own, F.length(header) + F.length("_text") + len(CLOSE)).cast("int").alias("mask_end"),
        )
    )


def dialogues(rotated: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Each perspective as one text with its masks, for conversations that fit in a row.

    ``masks`` lists (start, end) in characters of ``text``.
    """
    piece = F.struct(turn_col, "rendered", "mask_start", "mask_end")
    gathered = rotated.groupBy(conv_col, "perspective").agg(F.array_sort(F.collect_list(piece)).alias("_turns"))

    def add(done: Column, turn: Column) -> Column:
        start = F.length(done["text"])
        span = F.struct((start + turn["mask_start"]).alias("start"), (start + turn["mask_end"]).alias("end"))
        return F.struct(
            F.concat(done["text"], turn["rendered"]).alias("text"),
            F.when(turn["mask_start"].isNull(), done["masks"])
            .otherwise(F.concat(done["masks"], F.array(span)))
            .alias("masks"),
        )

    empty = F.struct(
        F.lit("").alias("text"), F.array().cast("array<struct<start:int,end:int>>").alias("masks")
    )
    return gathered.withColumn("_all", F.aggregate("_turns", empty, add)).select(
        conv_col, "perspective", "_all.text", "_all.masks"
    )
