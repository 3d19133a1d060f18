"""Prompt texts built from the recent messages of each conversation.

Each needs a few messages from the end of a conversation. Counting from the end first keeps
every group to those few rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.functions.text import strip_thinking
from dialogprep.operators.order import BLOCK_ROWS, scan
from dialogprep.operators.shape import is_role

# How many transcript lines and earlier questions a follow-up prompt carries.
TRANSCRIPT_LINES = 12
RECENT_QUESTIONS = 5


@dataclass(frozen=True)
class Wording:
    """Labels and lines of the prompts; replace them to match the prompts in use.

    Fixed values: ``user_label`` and the headings ``previous_question``, ``excerpt``, ``asked``
    and ``no_answer``. The other lines are this package's own.
    """

    user_label: str = "Tester"
    assistant_label: str = "Assistant"
    opening: str = (
        "\nThis is a new conversation, and you remember the end of the last one."
        "\nUse the question and answer below so that you do not repeat yourself."
    )
    previous_question: str = "\nPrevious tester question: "
    previous_answer: str = "\nAnswer to it: "
    short_previous_question: str = "\n\nYour previous question: "
    short_previous_answer: str = "\nAnswer to previous question: "
    followup: str = (
        "\nYou are in the middle of a conversation."
        "\nAsk a short follow-up question that builds on the latest answer."
    )
    excerpt: str = "\nConversation excerpt (oldest to newest):\n"
    asked: str = "\nQuestions you've already asked recently:\n"
    latest: str = "\nLatest answer that you should build upon:\n"
    no_answer: str = "(No recent answer available)"


def _joined(rows: DataFrame, line: Column, out: str) -> DataFrame:
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("t")))), lambda r: r["t"])
    return rows.groupBy("conv_id").agg(F.array_join(ordered, "\n").alias(out))


def transcript(df: DataFrame, limit: int = TRANSCRIPT_LINES, wording: Wording = Wording(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The last ``limit`` spoken messages per conversation, numbered from the start."""
    spoken = (F.col("role") != "system").cast("long")
    placed = scan(df, ["conv_id"], "turn", before={"_before": spoken}, after={"_after": spoken}, block_rows=block_rows)
    rows = placed.filter((F.col("role") != "system") & (F.col("_after") < limit))
    role = F.col("role")
    # capitalised: first letter upper, the others lower
    other = F.concat(F.upper(F.substring(role, 1, 1)), F.lower(F.substr(role, F.lit(2))))
    label = F.when(role == "user", wording.user_label).when(role == "assistant", wording.assistant_label).otherwise(other)
    text = F.when(role == "assistant", strip_thinking(F.col("content"))).otherwise(F.col("content"))
    line = F.concat((F.col("_before") + 1).cast("string"), F.lit(". "), label, F.lit(": "), text)
    return _joined(rows, line, "transcript")


def recent_questions(df: DataFrame, k: int = RECENT_QUESTIONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The last ``k`` user messages per conversation as bullets; empty ones then drop out."""
    asked = is_role("user")
    placed = scan(df, ["conv_id"], "turn", after={"_after": asked}, block_rows=block_rows)
    text = strip_thinking(F.col("content"))
    rows = placed.filter((F.col("role") == "user") & (F.col("_after") < k)).withColumn("_q", text).filter("_q <> ''")
    return _joined(rows, F.concat(F.lit("- "), F.col("_q")), "asked")


def last_reply(df: DataFrame) -> DataFrame:
    """The visible text of the last assistant message per conversation, empty if there is none."""
    last = F.max_by(F.when(F.col("role") == "assistant", F.col("content")), F.when(F.col("role") == "assistant", F.col("turn")))
    return df.groupBy("conv_id").agg(last.alias("_l")).select("conv_id", strip_thinking(F.col("_l")).alias("last_reply"))


def opening_prompt(context: DataFrame, base: str, wording: Wording = Wording(), short: bool = False) -> DataFrame:
    """Add ``prompt``, the request for an opening question, from ``prev_question`` and ``prev_answer``."""
    question, answer = F.col("prev_question"), F.col("prev_answer")
    if short:
        text = F.concat(
            F.lit(base + wording.short_previous_question), question, F.lit(wording.short_previous_answer), answer
        )
    else:
        text = F.concat(
            F.lit(base + wording.opening + wording.previous_question), question, F.lit(wording.previous_answer),
            strip_thinking(answer),
        )
    return context.withColumn("prompt", text)


def followup_prompt(df: DataFrame, base: str, wording: Wording = Wording(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation the request for the next question: ``(conv_id, prompt)``."""
    parts = (
        last_reply(df)
        .join(transcript(df, wording=wording, block_rows=block_rows), "conv_id", "left")
        .join(recent_questions(df, block_rows=block_rows), "conv_id", "left")
    )
    asked = F.when(F.coalesce("asked", F.lit("")) != "", F.concat(F.lit(wording.asked), F.col("asked"))).otherwise("")
    return parts.select("conv_id", F.concat(
        F.lit(base + wording.followup + wording.excerpt), F.coalesce("transcript", F.lit("")), asked,
        F.lit(wording.latest), F.coalesce(F.nullif("last_reply", F.lit("")), F.lit(wording.no_answer)),
    ).alias("prompt"))
