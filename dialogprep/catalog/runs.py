"""Generation and evaluation runs and the reports on them."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from dialogprep.catalog import mixing
from dialogprep.catalog.registry import query
from dialogprep.catalog.views import GENERATION_LOG, MANTRA, MESSAGE_LOG, NAME, generation_log, sql, table, view
from dialogprep.operators import examples, runs, shape
from dialogprep.plans import generate as rounds
from dialogprep.session import scratch_path
from dialogprep.streaming import ingest

_GEN = sql(GENERATION_LOG)
PROVIDERS = ["alpha", "beta", "gamma"]
_START = "timestamp '2024-01-01 00:00:00'"


def _log(spark, sf):
    return generation_log(spark, sf)


def _assigned(spark, sf):
    usable = runs.usable_providers([*PROVIDERS, "unused"], None, {p: "key" for p in PROVIDERS})
    return runs.assign_round_robin(_log(spark, sf), usable)


_ASSIGNED = f"select *, ['alpha', 'beta', 'gamma'][item % 3 + 1] as provider from ({_GEN})"


@query(f"select item, conv_id, provider from ({_ASSIGNED})")
def assign_round_robin(spark, sf):
    return _assigned(spark, sf).select("item", "conv_id", "provider")


@query(f"select provider, count(*) as n from ({_ASSIGNED}) group by provider")
def provider_counts(spark, sf):
    return runs.provider_counts(_assigned(spark, sf))


@query(f"""select done, elapsed, done / 1000 * 100 as percent, done / elapsed * 3600 as overall_rate, n / elapsed * 3600 as session_rate,
  (1000 - done) / (done / elapsed * 3600) as overall_hours_left, (1000 - done) / (n / elapsed * 3600) as session_hours_left
from (select count(*) + 25 as done, count(*) as n, (epoch_us(max(finished_at)) - epoch_us({_START})) / 1e6::double as elapsed from ({_GEN}))""")
def progress(spark, sf):
    return runs.progress(_log(spark, sf), 1000, 25, F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query(f"""with recursive l as (select item + 1 as n, epoch_us(finished_at) as at from ({_GEN})),
 r as (select 0::bigint as n, epoch_us({_START}) as last, false as due
   union all select l.n, case when l.n % 10 = 0 or l.at - r.last > 1800000000 then l.at else r.last end, l.n % 10 = 0 or l.at - r.last > 1800000000
   from r join l on l.n = r.n + 1)
select n, n % 50 = 0 as sample from r where due""")
def report_points(spark, sf):
    return runs.report_points(_log(spark, sf), F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query(f"select count(*) as existing, greatest(0, 150 - count(*))::bigint as remaining from ({_GEN})")
def resume_plan(spark, sf):
    return runs.resume_plan(_log(spark, sf), 150)


@query(f"select item, conv_id from ({_GEN}) order by item limit 40")
def take_target(spark, sf):
    return runs.take_target(_log(spark, sf).select("item", "conv_id"), ["item"], 40)


@query("""select strftime(p, '%Y-%m-%d %H:%M:%S.%f') as quiet_from, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as quiet_until
from (select ts, lag(ts) over (order by ts) as p from events) where epoch_us(ts) - epoch_us(p) > 600000000""")
def stalls(spark, sf):
    found = runs.stalls(table(spark, sf, "events"), gap_seconds=600)
    return found.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("quiet_from", "quiet_until")])


def _flaky():
    """A model that refuses some texts for good and fails at the first try of the others."""
    seen = set()

    def ask(text):
        if len(text) % 7 == 0 or text not in seen:
            seen.add(text)
            raise RuntimeError("try again")
        return "echo: " + text

    return ask


@query("select conv_id, turn, case when length(text) % 7 = 0 then '' else 'echo: ' || text end as response from conversations")
def generate(spark, sf):
    requests = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("prompt"))
    return runs.generate(requests, _flaky, wait_seconds=0).select("conv_id", "turn", "response")


def tester():
    def ask(payload):
        said = json.loads(payload)[-1]["content"]
        return "" if len(said) % 23 == 0 else f"<think>next</think> Question {len(said)}?"

    return ask


def assistant():
    def ask(payload):
        messages = json.loads(payload)
        question = messages[1]["content"]
        if len(messages) > 2:
            return f"Done, {len(messages[3]['content'])} letters."
        n = sum(map(ord, question))
        act = ('add_memory(input_text=["%s"])' % hashlib.md5(question.encode()).hexdigest(), "recall_memories()", "delete_memory(indices=[2])", "check_watch()")[n % 4]
        return f"<think>the user asks {n % 10}</think><tool_call>{act}</tool_call> Answer {n}"

    return ask


def rewriter():
    return lambda payload: f"The user wants {len(payload) % 50}"


@query()
def generate_conversations(spark, sf):
    """Every conversation of the table seeds a new one; every third user starts with a reminder for each of the user's seeds."""
    ends = shape.last_two_messages(view(spark, sf, MESSAGE_LOG))
    owner = F.concat(F.lit("user "), (F.col("conv_id") % 50).cast("string"))
    seeds = ends.select(
        "conv_id", shape.target_messages(F.col("conv_id") % 7 + 2).alias("target"), owner.alias("owner"),
        F.coalesce("question", F.lit("None.")).alias("prev_question"), F.coalesce("answer", F.lit("None.")).alias("prev_answer"),
    )
    none, at = F.lit(None).cast("string"), F.lit("2023-12-31 00:00:00").cast("timestamp")
    reminders = ends.filter(F.col("conv_id") % 3 == 0).select(
        F.lit("reminder").alias("kind"), owner.alias("owner"), F.col("conv_id").cast("long").alias("entry_id"), none.alias("content"),
        F.concat(F.lit("Seed "), F.col("conv_id").cast("string")).alias("subject"), F.lit("Look again").alias("body"), at.alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_checked_at"), F.lit(None).cast("timestamp").alias("completed_at"))
    made = rounds.generate_conversations(
        seeds, {"tester": tester, "assistant": assistant, "rewriter": rewriter}, rounds.Prompts("T", "U", "S", "R"),
        user_id="robin", name=NAME, mantra=MANTRA, started_at="2024-01-01 00:00:00", entries=reminders, wait_seconds=0,
    )
    return made.messages


@query(f"select format('conv_{{:06d}}', n) as id, n, conv_id, worker_id from (select row_number() over (order by item) as n, * from ({_GEN}))")
def ingest_stream(spark, sf):
    """The log arrives in two halves; numbering goes on where the first one ended, and every conversation is kept."""
    log = _log(spark, sf)
    n = log.count()
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "saved", "stream"))
    for part in (f"item < {n // 2}", f"item >= {n // 2}"):
        log.filter(part).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(log.schema).parquet(inbox)
        ingest.ingest_stream(source, out, checkpoint, target=n).awaitTermination()
    return ingest.stored_conversations(spark, out).select("id", "n", "conv_id", "worker_id")


def _model(name):
    def client():
        return lambda text: f"{name}: {text}"

    return client


@query("select item_id as question_no, model, model || ': ' || text as response from benchmark, (values ('m1'), ('m2')) v(model)")
def evaluate(spark, sf):
    prompts = table(spark, sf, "benchmark").select(F.col("item_id").alias("question_no"), F.col("text").alias("prompt"))
    return runs.evaluate(prompts, {"m1": _model("m1"), "m2": _model("m2")}).select("question_no", "model", "response")


def _training_log(spark, sf, norm):
    v = F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("step"), F.when(F.col("event_id") % 4 != 0, v / 10).alias("epoch"),
        F.when(F.col("event_id") % 3 != 0, v).alias("loss"), F.when(F.col("event_id") % 5 != 0, v / 100).alias("lr"), norm.alias("grad_norm"),
    )


_SERIES = """with l as (select event_id as step, coalesce(case when event_id % 4 <> 0 then value / 10 end, (row_number() over (order by event_id) - 1)::double) as epoch,
  coalesce(case when event_id % 3 <> 0 then value end, 0::double) as loss, coalesce(case when event_id % 5 <> 0 then value / 100 end, 0::double) as lr,
  case when event_id % 2 = 0 then value else 0::double end as grad_norm from events)
select step, epoch, 'loss' as metric, loss as value from l union all select step, epoch, 'lr', lr from l"""


@query(_SERIES + " union all select step, epoch, 'grad_norm', grad_norm from l")
def metric_series(spark, sf):
    return runs.metric_series(_training_log(spark, sf, F.when(F.col("event_id") % 2 == 0, F.col("value"))))


@query(_SERIES)
def metric_series_without_norms(spark, sf):
    return runs.metric_series(_training_log(spark, sf, F.when(F.col("event_id") % 2 == 0, F.lit(0.0))))


@query(mixing.STEPS + f""", one as (select mega_id, ord, content from mix_flat order by mega_id, ord limit 1)
select 0::bigint as idx, string_agg({mixing._RENDER.replace('role', 'f.role').replace('content', 'f.content')}, '' order by f.ord)
  filter (f.ord < o.ord) || {mixing._GENERATION} || any_value(o.content) as prompt, 'seen' as response
from one o join flat f on f.mega_id = o.mega_id and f.ord <= o.ord""".replace("mix_flat", "flat where role = 'assistant'"))
def validation_preview(spark, sf):
    # only the first example is shown, so only its block is encoded
    first = examples.first_example(mixing._flat(spark, sf))
    rows = examples.encode_examples(first, mixing._T, 100_000, mixing.EOS).withColumn("idx", F.lit(0).cast("long"))

    def decode(ids):
        return examples.utf8_decoder(F.array_remove(ids, mixing.EOS))

    return runs.validation_preview(rows, lambda: (lambda text: "seen"), decode)
