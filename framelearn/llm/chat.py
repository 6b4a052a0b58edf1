"""Chat formatting by perspective: each participant in turn is the assistant, the others are named users.

DataFrame functions only. A rendered dialogue is kept as its turns, each with
its place in the dialogue's text, so a conversation of any length is never one
row or one task; ``dialogues`` joins the turns of conversations of bounded
length into texts with masks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.llm.common import narrow
from framelearn.plans.scale import ROWS_PER_BUCKET, running_total
from framelearn.session import materialize

START, END = "<|im_start|>", "<|im_end|>"

#: Speakers that take no perspective; their turns stay as they are.
NARRATORS = ("system",)


def escaped(text: Column) -> Column:
    """Text that cannot hold a control mark: ``<|`` becomes ``<\\|``; what was ``<\\|`` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: tuple[str, ...] = NARRATORS,
    rows_per_range: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Every turn of every conversation once per participant of it.

    Returns conv_id, perspective, position (0.. within the conversation), role
    ("assistant" for the perspective's own turns, "system" for narrators, else
    "user"), name (the speaker of a user turn, else NULL), segment (the rendered
    turn), start and end (its code points in the rendered dialogue), mask_start
    and mask_end (the code points to learn: text and end mark of assistant
    turns; NULL elsewhere). Joined by position the segments are the dialogue.

    A conversation of narrators alone has no perspective and gives no rows. A
    NULL speaker is a participant named "unknown"; a NULL text is empty; rows
    with a NULL conversation form one conversation of their own; turns are
    ordered by turn (NULL first), speaker and text, repeated rows staying; an
    empty table gives an empty one. Other columns are not read. Positions and
    starts are running totals over key ranges, so one long conversation is dealt
    over many tasks. A conversation's participants are rows of their own, joined
    on the conversation.
    """
    rows = narrow(turns, conv_id=conversation, turn=turn, speaker=speaker, text=text)
    rows = rows.withColumn("speaker", F.coalesce(F.col("speaker").cast("string"), F.lit("unknown"))).withColumn(
        "text", F.coalesce(F.col("text"), F.lit(""))
    )
    # no NULL in the ordering key; repeated rows get a number so that the key tells rows apart
    rows = rows.select(
        F.col("conv_id").isNotNull().cast("int").alias("_ck"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_c"),
        F.col("turn").isNotNull().cast("int").alias("_tk"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("_t"),
        "speaker",
        F.sha2("text", 256).alias("_h"),
        "text",
        F.col("speaker").isin(*narrators).alias("narrates") if narrators else F.lit(False).alias("narrates"),
    )
    key = ["_ck", "_c", "_tk", "_t", "speaker", "_h"]
    counted = rows.groupBy(*key, "text", "narrates").agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.select(*key, "text", "narrates", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i"))
    key = [*key, "_i"]
    body = escaped(F.col("text"))
    rows = rows.withColumn("_body", F.length(body)).withColumn("_name", F.length(_name(F.col("speaker"))))
    # the length of a turn as a named user, as a narrator and as the assistant
    other = F.when(F.col("narrates"), F.lit(len(START) + len("system\n") + len(END) + 1)).otherwise(
        F.lit(len(START) + len("user name=\n") + len(END) + 1) + F.col("_name")
    )
    rows = rows.withColumn("_len", (other + F.col("_body")).cast("long"))
    rows = materialize(rows)
    by = ["_ck", "_c"]
    people = rows.filter(~F.col("narrates")).select(*by, F.col("speaker").alias("perspective")).distinct()
    spoken = F.lit(len(START) + len("assistant\n") + len(END) + 1) + F.col("_body")
    dealt = running_total(rows, key[2:], F.lit(1), by, "position", rows_per_range)
    # one row per participant and turn; a turn's length depends on whether it is the participant's own
    seen = dealt.join(people, by).withColumn("_own", F.col("speaker") == F.col("perspective"))
    seen = seen.withColumn("_size", F.when(F.col("_own"), spoken).otherwise(F.col("_len")).cast("long"))
    seen = running_total(seen, ["position"], F.col("_size"), [*by, "perspective"], "start", rows_per_range)
    role = F.when(F.col("_own"), "assistant").when(F.col("narrates"), "system").otherwise("user")
    head = F.concat(
        F.lit(START), role, F.when(role == "user", F.concat(F.lit(" name="), _name(F.col("speaker")))).otherwise(F.lit("")), F.lit("\n")
    )
    out = seen.select(
        F.when(F.col("_ck") == 1, F.col("_c")).alias("conv_id"),
        "perspective",
        "position",
        role.alias("role"),
        F.when(role == "user", F.col("speaker")).alias("name"),
        F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        "start",
        (F.col("start") + F.col("_size")).alias("end"),
        F.when(F.col("_own"), F.col("start") + F.length(head)).cast("long").alias("mask_start"),
        F.when(F.col("_own"), F.col("start") + F.col("_size") - 1).cast("long").alias("mask_end"),
    )
    return out


def _name(speaker: Column) -> Column:
    """A speaker's name on the head line: white space and marks would break the line, so they become "_"."""
    return F.regexp_replace(speaker, r"[\s<>|=]", "_")


def dialogues(turns: DataFrame, max_turns: int = 1000, **columns) -> DataFrame:
    """Whole texts: conv_id, perspective, text, masks (array of start and end), for conversations of at most ``max_turns``.

    Longer ones stay with ``perspectives``, whose rows hold the same text in pieces.
    """
    rows = perspectives(turns, **columns)
    sizes = rows.groupBy("conv_id", "perspective").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= max_turns)
    short = rows.alias("a").join(
        sizes.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.perspective") == F.col("b.perspective")), "left_semi"
    )
    packed = short.groupBy("conv_id", "perspective").agg(
        F.array_sort(F.collect_list(F.struct("position", "segment", "mask_start", "mask_end"))).alias("p")
    )
    masks = F.transform(F.filter("p", lambda x: x["mask_start"].isNotNull()), lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end")))
    return packed.select("conv_id", "perspective", F.array_join(F.transform("p", lambda x: x["segment"]), "").alias("text"), masks.alias("masks"))
