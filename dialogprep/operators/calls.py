"""Tool calls as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.functions import toolcalls as T

ADDS_TEXT = ("add_memory", "add_diary")
BY_INDEX = ("delete_memory", "delete_diary", "complete_reminder", "delete_reminder")


def tool_calls(
    df: DataFrame, content: str = "content", first_only: bool = True, strict: bool = False, tools: Sequence[str] | None = None
) -> DataFrame:
    """One row per valid call, next to the columns of its reply other than the text.

    Calls that name no tool or whose arguments do not parse vanish; later ones keep their
    ``call_pos``. ``first_only`` keeps the first string of a list argument and drops the rest.
    ``tools`` names the only tools whose calls are wanted: the arguments of others are not parsed.
    """
    keep = [c for c in df.columns if c != content]
    call, tool = F.col("_call.call"), F.col("_call.tool")
    # Classification and parsing sit inside generators: a filter on a generator's output is not
    # pushed through it, so each expression runs once per call.
    named = F.transform(
        T.extract_tool_calls(F.col(content)), lambda c: F.struct(c.alias("call"), T.classify_tool(c, strict).alias("tool"))
    )
    rows = df.select(*keep, F.posexplode(named).alias("call_pos", "_call")).filter(tool.isNotNull() if tools is None else tool.isin(*tools))
    # what is cut out is read more than once to get its value
    pieces = F.struct(
        F.when(tool.isin(*ADDS_TEXT), T.list_body(call)).alias("_list"),
        F.when(tool.isin(*BY_INDEX), T.index_arg(call)).alias("index_arg"),
        F.when(tool == "add_reminder", T.string_literal(call, "subject")).alias("_subject"),
        F.when(tool == "add_reminder", T.string_literal(call, "reminder_text")).alias("_body"),
    )
    cut = rows.select(*keep, F.col("call_pos").cast("long").alias("call_pos"), tool.alias("tool"), F.inline(F.array(pieces)))
    texts = T.list_values(F.col("_list"))
    if first_only:
        texts = F.slice(texts, 1, 1)
    values = F.struct(
        texts.alias("_texts"), T.literal_value(F.col("_subject")).alias("subject"), T.literal_value(F.col("_body")).alias("body"),
    )
    parsed = cut.select(*keep, "call_pos", "tool", "index_arg", F.inline(F.array(values)))
    tool = F.col("tool")
    valid = (
        F.when(tool.isin(*ADDS_TEXT), F.coalesce(F.size("_texts"), F.lit(0)) > 0)
        .when(tool.isin(*BY_INDEX), F.col("index_arg").isNotNull())
        .when(tool == "add_reminder", (F.col("subject") != "") & (F.col("body") != ""))
        .otherwise(True)
    )
    return (
        parsed.filter(valid)
        .select(*keep, "call_pos", "tool", F.posexplode_outer("_texts").alias("item_pos", "text_arg"), "index_arg", "subject", "body")
        .withColumn("item_pos", F.coalesce("item_pos", F.lit(0)).cast("long"))
    )


def tool_result(outcome: Column) -> Column:
    return F.concat(F.lit("<tool_result>"), F.to_json(outcome), F.lit("</tool_result>"))


def tool_results_text(outcomes: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The results of each reply's calls in call order, separated by blank lines.

    A group is the calls of one reply, so it is bounded by the length of a reply.
    """
    rows = outcomes.select(*keys, F.struct("call_pos", tool_result(F.struct(*fields)).alias("t")).alias("_r"))
    return rows.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("_r")), lambda r: r["t"]), "\n\n").alias("tool_text")
    )
