"""Multi-round conversation generation. All conversations take each step together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.functions.text import assemble_reply, rewrite_source, splice, strip_thinking
from dialogprep.operators.calls import tool_calls, tool_results_text
from dialogprep.operators.dialogue import Wording, followup_prompt, opening_prompt
from dialogprep.operators.runs import Client, generate, request_messages
from dialogprep.operators.store import ENTRY_COLUMNS, bulletin, opening_messages, replay, with_recall_messages
from dialogprep.session import durable

_ENTRY_SCHEMA = (
    "kind string, owner string, entry_id long, content string, subject string, body string, "
    "created_at timestamp, last_checked_at timestamp, completed_at timestamp"
)


@dataclass(frozen=True)
class Prompts:
    tester_system: str = ""
    tester_user: str = ""
    assistant_system: str = ""
    rewriter_system: str = ""
    rewrite_before: str = "Thoughts to rewrite:\n"
    rewrite_after: str = "\nEnd of the thoughts. Say them again in your own natural words, in the first person."
    wording: Wording = field(default_factory=Wording)


@dataclass(frozen=True)
class Generated:
    messages: DataFrame  # (conv_id, turn, role, content) of complete conversations
    entries: DataFrame  # store contents at the end


def _ask(df: DataFrame, client: Callable[[], Client], payload: Column, out: str, **options) -> DataFrame:
    """One model call per row, answered once and written. The client gets the messages as JSON text."""
    asked = df.withColumn("_prompt", F.to_json(payload))
    return durable(generate(asked, client, prompt="_prompt", out=out, **options).drop("_prompt"), "asked")


def _reply(
    questions: DataFrame, entries: DataFrame, clients: dict[str, Callable[[], Client]], prompts: Prompts, owners: DataFrame,
    name: str, mantra: str, round_ts: Column, last_ids: dict[str, int], options: dict,
) -> tuple[DataFrame, DataFrame]:
    """Answers to ``(conv_id, turn, question)``: the model's reply, its tool calls, a continuation, a rewrite.

    A call works on the lists of its conversation's owner, by ``owners(conv_id, user_id)``.
    """
    system = F.lit(prompts.assistant_system)
    replies = _ask(questions, clients["assistant"], request_messages(system, F.col("question")), "reply", **options).filter("reply <> ''")
    calls = tool_calls(
        replies.join(owners, "conv_id").select("user_id", round_ts.alias("ts"), F.col("conv_id").alias("op_id"), F.col("reply").alias("content"))
    )
    done = replay(calls, state=entries, start_ids=last_ids)
    outcomes = with_recall_messages(done)
    results = tool_results_text(outcomes, ["op_id"], ["success", "message", "entry_id", "timestamp"])
    joined = durable(replies.join(results.withColumnRenamed("op_id", "conv_id"), "conv_id", "left"), "called")
    called = joined.filter("tool_text is not null")
    continued = _ask(
        called, clients["assistant"], request_messages(system, F.col("question"), F.col("reply"), F.col("tool_text")), "more", **options
    ).withColumn("reply", splice(F.col("reply"), F.col("more"))).drop("more")
    answers = joined.filter("tool_text is null").unionByName(continued)
    thought = answers.drop("tool_text").withColumn("_think", rewrite_source(F.col("reply")))
    request = F.concat(F.lit(prompts.rewrite_before), F.col("_think"), F.lit(prompts.rewrite_after))
    rewritten = _ask(
        thought.filter("_think is not null"), clients["rewriter"], request_messages(F.lit(prompts.rewriter_system), request), "_new", **options
    ).unionByName(thought.filter("_think is null").withColumn("_new", F.lit(None).cast("string")))
    final = rewritten.select(
        "conv_id", "turn", assemble_reply(F.col("reply"), F.col("_new"), name, mantra).alias("content")
    )
    return final, durable(done.entries, "entries")


def openings(owners: DataFrame, entries: DataFrame, system_prompt: str, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """Opening messages ``(conv_id, turn, role, content)`` and the entries as they are after it.

    An owner's open reminders are stamped and listed in a second system message of each of the owner's
    conversations. Turns count up to -1, so a conversation without reminders has its prompt there.
    """
    users = owners.select(F.col("user_id").alias("owner")).distinct()
    listed = bulletin(entries, stamp, users)
    said = owners.join(listed, owners["user_id"] == listed["owner"], "left").select("conv_id", opening_messages(F.lit(system_prompt), F.col("bulletin")).alias("m"))
    said = said.select("conv_id", F.size("m").alias("n"), F.posexplode("m").alias("k", "m"))
    said = said.select("conv_id", (F.col("k") - F.col("n")).cast("long").alias("turn"), "m.role", "m.content")
    shown = (F.col("kind") == "reminder") & F.col("completed_at").isNull() & F.col("_shown").isNotNull()
    marked = entries.join(users.withColumn("_shown", F.lit(True)), "owner", "left")
    return said, marked.withColumn("last_checked_at", F.when(shown, stamp).otherwise(F.col("last_checked_at"))).select(*ENTRY_COLUMNS)


def generate_conversations(
    seeds: DataFrame, clients: dict[str, Callable[[], Client]], prompts: Prompts, user_id: str, name: str, mantra: str,
    started_at: str, entries: DataFrame | None = None, **options,
) -> Generated:
    """Conversations for seeds ``(conv_id, target, prev_question, prev_answer)``.

    ``clients`` makes the functions that play tester, assistant and rewriter. ``target`` is
    even; the rounds go up to the largest one. A conversation whose question or reply comes back empty
    is dropped. A column ``owner`` of the seeds names the user whose memories and reminders a
    conversation works on; without it, or where it is null, that is ``user_id``. The owner's open
    reminders open the conversation as a second system message and are stamped by that. Tool calls
    of a round run in the order of ``conv_id`` within an owner, and the store of a round is what the
    round before left. The loop runs over rounds only, and every round's result is a written table.
    """
    spark = seeds.sparkSession
    state = entries if entries is not None else spark.createDataFrame([], _ENTRY_SCHEMA)
    start = F.lit(started_at).cast("timestamp")
    owner = F.coalesce(F.col("owner").cast("string"), F.lit(user_id)) if "owner" in seeds.columns else F.lit(user_id)
    owners = durable(seeds.select("conv_id", owner.alias("user_id")), "owners")
    opening, state = openings(owners, state, prompts.assistant_system, start)
    opening, state = durable(opening, "opening"), durable(state, "entries")
    tester_system = F.lit(prompts.tester_system)
    first = opening_prompt(seeds.drop("owner"), prompts.tester_user, prompts.wording)
    asked = _ask(first, clients["tester"], request_messages(tester_system, F.col("prompt")), "q", **options)
    question = asked.select(
        "conv_id", "target", F.lit(0).cast("long").alias("turn"), strip_thinking(F.col("q")).alias("question")
    ).filter("question <> ''")
    said = question.select("conv_id", "turn", F.lit("user").alias("role"), F.col("question").alias("content"))
    targets = question.select("conv_id", "target")
    max_messages = question.agg(F.max("target")).first()[0] or 0
    for turn in range(1, max_messages, 2):
        at = start + F.expr(f"make_dt_interval(0, 0, 0, {turn})")
        last_ids = {r["kind"]: r["n"] for r in state.groupBy("kind").agg(F.max("entry_id").alias("n")).collect()}  # three kinds at most
        answers, state = _reply(question, state, clients, prompts, owners, name, mantra, at, last_ids, options)
        said = said.unionByName(answers.select("conv_id", F.lit(turn).cast("long").alias("turn"), F.lit("assistant").alias("role"), "content"))
        said = durable(said, "said")
        if turn + 1 >= max_messages:
            break
        going = targets.filter(F.col("target") > turn + 1).join(answers.select("conv_id"), "conv_id")
        context = said.join(going.select("conv_id"), "conv_id", "left_semi")
        request = followup_prompt(context, prompts.tester_user, prompts.wording)
        asked = _ask(request, clients["tester"], request_messages(tester_system, F.col("prompt")), "q", **options)
        question = (
            asked.select("conv_id", F.lit(turn + 1).cast("long").alias("turn"), strip_thinking(F.col("q")).alias("question"))
            .filter("question <> ''").join(targets, "conv_id").select("conv_id", "target", "turn", "question")
        )
        said = said.unionByName(question.select("conv_id", "turn", F.lit("user").alias("role"), F.col("question").alias("content")))
    lengths = said.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).join(targets, "conv_id").filter("n = target")
    complete = said.join(lengths.select("conv_id"), "conv_id", "left_semi")
    opening = opening.join(lengths.select("conv_id"), "conv_id", "left_semi").select("conv_id", "turn", "role", "content")
    return Generated(opening.unionByName(complete), state.select(*ENTRY_COLUMNS))
