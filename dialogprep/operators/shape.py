"""Conversations in long form: one row per message, ordered by an integer turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.order import BLOCK_ROWS, ordered_index, scan


def is_role(role: str) -> F.Column:
    return (F.col("role") == role).cast("long")


def normalize_role(df: DataFrame) -> DataFrame:
    return df.withColumn("role", F.lower("role"))


def segment_at_reply(
    df: DataFrame, keys: Sequence[str] = ("conv_id",), pos: str = "turn", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``seg``: a segment ends at, and includes, each assistant message.

    ``closed`` tells whether the segment has its assistant message. For a log without
    conversation ids pass ``keys=()`` and the file order as ``pos``.
    """
    reply = is_role("assistant")
    marked = scan(df, keys, pos, before={"seg": reply}, after={"_later": reply}, block_rows=block_rows)
    return marked.withColumn("closed", (F.col("_later") + reply) > 0).drop("_later")


def drop_open_segments(df: DataFrame) -> DataFrame:
    return df.filter("closed").drop("closed")


def number_messages(
    df: DataFrame, keys: Sequence[str], pos: str, out: str = "pos", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the 0-based place of each message in its conversation."""
    return scan(df, keys, pos, before={out: F.lit(1).cast("long")}, block_rows=block_rows)


def to_message_log(df: DataFrame, keys: Sequence[str] = ("conv_id",), pos: str = "turn") -> DataFrame:
    """Flatten conversations into one log ``(seq, role, content)``."""
    return ordered_index(df.select(*keys, pos, "role", "content"), [*keys, pos], "seq").select(
        "seq", "role", "content"
    )


def explode_conversations(df: DataFrame, messages: str = "messages", keep: Sequence[str] = ("conv_id",)) -> DataFrame:
    """Array form to long form."""
    return df.select(*keep, F.posexplode(messages).alias("turn", "_m")).select(
        *keep, F.col("turn").cast("long").alias("turn"), "_m.role", "_m.content"
    )


def source_counts(df: DataFrame, key: str = "conv_key") -> DataFrame:
    """Conversations per source. One row per conversation leaves each task before the count."""
    return df.groupBy("source", key).agg(F.count(F.lit(1)).alias("_m")).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_conversations"), F.sum("_m").alias("n_messages")
    )


def target_messages(requested: F.Column) -> F.Column:
    """Message target of a conversation: one less than requested, even, and at least 4."""
    n = F.greatest(F.lit(4).cast("long"), requested.cast("long") - 1)
    return F.greatest(F.lit(4).cast("long"), n - n % 2)


def conversation_shape(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation: message count without system, and whether its roles follow the rule.

    The rule: system messages lead, then user and assistant alternate from user, and the last
    message is the assistant's.
    """
    spoken = (F.col("role") != "system").cast("long")
    numbered = scan(df, ["conv_id"], "turn", before={"_k": spoken}, block_rows=block_rows)
    expected = F.when(F.col("_k") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    right = F.when(F.col("role") == "system", F.col("_k") == 0).otherwise(F.col("role") == expected)
    return numbered.groupBy("conv_id").agg(
        F.sum(spoken).alias("n_spoken"),
        (F.bool_and(right) & (F.sum(spoken) % 2 == 0) & (F.sum(spoken) > 0)).alias("alternates"),
    )


def complete_conversations(df: DataFrame, target: F.Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Ids of complete conversations. ``target`` may use ``n_spoken``; by default any count is fine."""
    shape = conversation_shape(df, block_rows)
    rule = F.col("alternates")
    if target is not None:
        rule = rule & (F.col("n_spoken") == target)
    return shape.filter(rule).select("conv_id", "n_spoken")


def last_two_messages(df: DataFrame) -> DataFrame:
    """Per conversation the last message but one and the last, as ``question`` and ``answer``."""
    last = df.groupBy("conv_id").agg(F.max_by("content", "turn").alias("answer"), F.max("turn").alias("_last"))
    # turns are dense, so the message before the last has the turn one lower
    before = df.select("conv_id", (F.col("turn") + 1).alias("_last"), F.col("content").alias("question"))
    return last.join(before, ["conv_id", "_last"], "left").select("conv_id", "question", "answer")


def previous_context(
    log: DataFrame, df: DataFrame, by: Sequence[str] = ("worker_id",), default: str = "None.",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each item of a generation log, the closing question and answer of the item before it.

    "Before" is within the same worker (or over the whole log with ``by=()``). The place of an
    item in its worker is computed first, so the step back is an equi-join on two columns and
    a busy worker is spread over many tasks.
    """
    by = list(by)
    items = scan(log, by, "item", before={"_n": F.lit(1).cast("long")}, block_rows=block_rows)
    ends = last_two_messages(df)
    closed = items.select(*by, (F.col("_n") + 1).alias("_n"), "conv_id").join(ends, "conv_id").select(
        *by, "_n", F.col("question").alias("prev_question"), F.col("answer").alias("prev_answer")
    )
    return (
        items.join(closed, [*by, "_n"], "left")
        .withColumn("prev_question", F.coalesce("prev_question", F.lit(default)))
        .withColumn("prev_answer", F.coalesce("prev_answer", F.lit(default)))
        .drop("_n")
    )


def assign_ids(df: DataFrame, order: Sequence[str], start: int = 0, out: str = "id") -> DataFrame:
    """Number conversations ``conv_000001`` onwards, after ``start`` existing ones."""
    numbered = ordered_index(df, list(order), "_i")
    return numbered.withColumn(out, F.format_string("conv_%06d", F.col("_i") + start + 1)).drop("_i")
