"""Input views derived from the given tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.operators.order import ordered_index

SEED = 3407
MANTRA = "I speak in my own voice."
NAME = "Robin"

MESSAGE_LOG = "select conv_id, turn, role, text as content from {conversations}"

MARKED_REPLIES = """
select conv_id, turn, role,
  case when role <> 'assistant' then text
       when conv_id % 6 = 0 then concat('<think>', chr(10), 'plan ', turn, ' for the user', chr(10), '</think>', chr(10), chr(10), text)
       when conv_id % 6 = 1 then concat('lead <think>The user asked</think>', text)
       when conv_id % 6 = 2 then concat('</think> ', text)
       when conv_id % 6 = 3 then concat('<think>open ', text)
       when conv_id % 6 = 4 then concat('<think>a</think> <self>I am here.</self> ', text)
       else text end as content
from {conversations}"""

TOOL_LOG = """
select event_id as op_id, cast(user_id as varchar(20)) as user_id, ts,
  case event_type
    when 'signup' then concat('ok <tool_call>add_memory(input_text=["m', event_id, '", "extra"])</tool_call>')
    when 'click' then concat('<tool_call>add_reminder(subject="s', event_id, '", reminder_text="r', event_id, '")</tool_call> then <tool_call>check_watch()</tool_call>')
    when 'view' then '<tool_call>recall_memories()</tool_call> <tool_call>nonsense(1)</tool_call>'
    when 'error' then '<tool_call>delete_memory(indices=[1])</tool_call>'
    else '<tool_call>complete_reminder(indices=[1])</tool_call>' end as content
from {events}"""

DIARY_LOG = (
    TOOL_LOG.replace("add_memory", "add_diary").replace("delete_memory", "delete_diary").replace("recall_memories", "recall_diary")
)
REMINDER_LOG = TOOL_LOG.replace("recall_memories", "recall_reminders")
REMINDER_DELETE_LOG = TOOL_LOG.replace("complete_reminder", "delete_reminder")

# for the checking engine; Spark numbers the items by range in ``generation_log``
GENERATION_LOG = """
select item, conv_id, n_msgs, (item % 3)::int as worker_id, timestamp '2024-01-01 00:00:00' + to_seconds(item * 900 + item % 5 * 200) as finished_at
from (select cast(row_number() over (order by conv_id) - 1 as bigint) as item, conv_id, n_msgs
  from (select conv_id, count(*) as n_msgs from {conversations} group by conv_id))"""

MIX = """
select 'generated' as source, concat('g', conv_id, '_', seg) as conv_key, turn, role, content from (
  select conv_id, turn, role, text as content,
    coalesce(sum(case when role = 'assistant' then 1 else 0 end) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as seg,
    max(case when role = 'assistant' then turn else -1 end) over (partition by conv_id) as last_reply
  from {conversations}) where turn <= last_reply
union all select 'external', concat('e', conv_id), turn, role, text from {conversations}
union all select 'personality', concat('p', doc_id), 0, 'assistant', text from {documents}"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    # times without a zone are UTC
    stamps = {f: F.col(f).cast("timestamp") for f, t in df.dtypes if t.startswith("timestamp")}
    return df.withColumns(stamps) if stamps else df


def view(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    names = [n for n in ("conversations", "events", "documents") if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: table(spark, sf, n) for n in names})


def generation_log(spark: SparkSession, sf: str) -> DataFrame:
    """``(item, conv_id, n_msgs, worker_id, finished_at)``, one row per conversation, numbered in order."""
    counts = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_msgs"))
    return ordered_index(counts, ["conv_id"], "item").select(
        "item", "conv_id", "n_msgs", (F.col("item") % 3).cast("int").alias("worker_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("item") * 900 + F.col("item") % 5 * 200).alias("finished_at"))


def sql(text: str) -> str:
    """The same view for the checking engine."""
    return text.format(conversations="conversations", events="events", documents="documents")
