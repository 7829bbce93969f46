"""Chat formatting: each participant's view of a multi-party dialogue, that speaker as assistant, the others as named users.

A conversation is one training text for each participant. To keep a row small whatever the conversation's length, a text
comes in parts of part_turns turn numbers; the parts of a perspective, joined in order, are the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
NOBODY = "unknown"
_LAST = 2**63 - 1


def rotate_perspectives(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    speaker_column: str = "role",
    text_column: str = "text",
    system: str = "system",
    part_turns: int = 1024,
) -> DataFrame:
    """conv_id, speaker, part, n_turns, text, mask: one row for each participant and part of a conversation.

    ``mask`` lists the spans (start, end, in characters of that part's text) the model learns: what the speaker says, with
    the end mark, not the header. The system speaker is no participant; its turns are system turns in every view.

    Defined cases: turns are ordered by number, speaker and text, null numbers last; equal rows all stay. A null speaker
    is ``unknown``, a null text empty. ``<|`` inside texts and names is written ``< |`` so that no text can close a turn; a
    line break in a name is a space. A conversation with system turns only has no view; rows without a conversation id
    form one conversation with a null id. Extra columns are not read.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    turns = conversations.select(
        F.col(id_column).alias("conv_id"),
        F.coalesce(F.col(turn_column).cast("long"), F.lit(_LAST)).alias("turn"),
        F.translate(safe(F.coalesce(speaker_column, F.lit(NOBODY))), "\n", " ").alias("speaker"),
        safe(F.coalesce(text_column, F.lit(""))).alias("text"),
    ).withColumn("part", F.expr(f"(turn - pmod(turn, {part_turns})) div {part_turns}"))
    parts = turns.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    views = turns.where(F.col("speaker") != system).select("conv_id", "speaker").distinct()
    views = views.select(F.col("conv_id").alias("id"), "speaker")
    both = parts.join(views, F.col("conv_id").eqNullSafe(F.col("id")))

    def header(speaker: Column) -> Column:
        return F.concat(
            F.lit(START),
            F.when(speaker == F.col("speaker"), "assistant").when(speaker == system, "system").otherwise(F.concat(F.lit("user name="), speaker)),
            F.lit("\n"),
        )

    def step(done: Column, turn: Column) -> Column:
        begin = done["at"] + F.length(header(turn["speaker"]))
        end = begin + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["speaker"] == F.col("speaker"), F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    nothing = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return both.select(
        "conv_id",
        "speaker",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(header(t["speaker"]), t["text"], F.lit(END))), "").alias("text"),
        F.aggregate("turns", nothing, step, lambda done: done["spans"]).alias("mask"),
    )


def mask_text(mask: Column) -> Column:
    """Spans as text: ``start-end`` joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
