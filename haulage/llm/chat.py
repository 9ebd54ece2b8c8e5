"""Chat formatting: multi-party perspective rotation, on DataFrame functions alone.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and all other
speakers as named users; mask spans mark what the assistant says. System turns are instructions: they stay system turns
in all perspectives and are no participants.

Format of a turn: <|im_start|>system, user or assistant, then " name=" and the name for a user, newline, text,
<|im_end|>, newline. The turn markers inside texts are broken by a space after "<", so a text cannot close its turn.

A perspective is one row for each section of `section` consecutive turn numbers, so that a conversation with a third of
all turns is spread over tasks: turns meet only within their section, and the sections of a perspective, in order, give
the whole dialogue. Ordinary conversations have one section. Participants are counted with map-side combine and joined
by conversation, a join that Spark splits at run time where one conversation has most of the sections.

Turns are ordered by number, equal numbers by speaker and text; repeated rows stay. A null turn number comes last, in a
section of its own; a null speaker is a participant named "unknown"; a null text is empty. A null conversation is a
conversation. A conversation of system turns alone has no perspective. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.llm import staging

# Fixed words of the format.
START, END = "<|im_start|>", "<|im_end|>"
UNKNOWN = "unknown"


def safe(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|im_(?:start|end)\|>)", "< $1")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[\s<>|]", "_")


def rotated(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system_speakers: tuple[str, ...] = ("system",),
    section: int = 256,
) -> DataFrame:
    """conversation, section, assistant, n_turns, n_own, text, mask ([{start, end}] in code points, end exclusive)."""
    rows = turns.select(
        F.col(conversation).alias("conversation"),
        F.floor(F.col(turn) / F.lit(section)).cast("long").alias("section"),
        F.struct(
            F.col(turn).isNull().alias("last"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(speaker).cast("string"), F.lit(UNKNOWN)).alias("speaker"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    is_system = F.col("said.speaker").isin(*system_speakers)
    speakers = staging.staged(
        rows.filter(~is_system).select(F.col("conversation").alias("c"), F.col("said.speaker").alias("assistant")).distinct(),
        "chat-speakers",
    )
    sections = staging.staged(
        rows.groupBy("conversation", "section").agg(F.array_sort(F.collect_list("said")).alias("said")), "chat-sections"
    )
    views = sections.join(speakers, F.expr("conversation <=> c"))
    own = lambda s: s["speaker"] == F.col("assistant")
    header = lambda s: F.when(own(s), "assistant").when(s["speaker"].isin(*system_speakers), "system").otherwise(
        F.concat(F.lit("user name="), safe_name(s["speaker"]))
    )
    parts = views.withColumn(
        "parts",
        F.transform(
            "said",
            lambda s: F.struct(
                own(s).alias("own"),
                F.concat(F.lit(START), header(s), F.lit("\n")).alias("head"),
                F.concat(safe(s["text"]), F.lit(END)).alias("body"),
            ),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        grown = F.when(p["own"], F.concat(state["mask"], span)).otherwise(state["mask"])
        return F.struct((end + 1).alias("at"), grown.alias("mask"))

    return parts.select(
        "conversation",
        "section",
        "assistant",
        F.size("parts").cast("long").alias("n_turns"),
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("parts", start, step)["mask"].alias("mask"),
    )


def perspectives(turns: DataFrame, **options) -> DataFrame:
    """conv_id, section, assistant, n_turns, n_own, mask (start-end, comma-joined), text."""
    spans = F.array_join(
        F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return rotated(turns, **options).select(
        F.col("conversation").alias("conv_id"), "section", "assistant", "n_turns", "n_own", spans.alias("mask"), "text"
    )
