"""Generation and evaluation runs over tables, and reports on their logs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window as W

from dialogprep.operators.order import BLOCK_ROWS, ordered_index, scan

Client = Callable[[str], str]

# Report every so many items or seconds, show a sample line every so many items.
REPORT_ITEMS = 10
SAMPLE_ITEMS = 50
QUIET_SECONDS = 1800
RETRIES = 3
WAIT_SECONDS = 5


def usable_providers(listed: Sequence[str], override: Sequence[str] | None, keys: dict[str, str | None]) -> list[str]:
    """Providers in use: the override if given, else the listed ones, without those that lack a key."""
    names = list(override) if override else list(listed)
    return [n for n in names if keys.get(n)]


def assign_round_robin(items: DataFrame, providers: Sequence[str], pos: str = "item") -> DataFrame:
    """Hand out items in turn. ``pos`` is the dense 0-based place of an item."""
    if not providers:
        raise ValueError("no provider is usable")
    names = F.array(*[F.lit(p) for p in providers])
    return items.withColumn("provider", F.element_at(names, (F.col(pos) % len(providers) + 1).cast("int")))


def provider_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("provider").agg(F.count(F.lit(1)).alias("n")).orderBy("provider")


def progress(log: DataFrame, target: int, existing: int, started_at: Column, now: Column | None = None) -> DataFrame:
    """One row: done, percent, rates per hour and hours left.

    ``overall`` figures include what existed before the run started, ``session`` ones do not.
    """
    now = F.max("finished_at") if now is None else now
    done = F.col("done")
    elapsed = F.col("elapsed")

    def rate(n: Column) -> Column:
        return F.when(elapsed > 0, n / elapsed * 3600).otherwise(F.lit(0.0))

    def left(r: Column) -> Column:
        return F.when(r > 0, (target - done) / r).otherwise(F.lit(0.0))

    facts = log.agg(
        (F.count(F.lit(1)) + existing).alias("done"),
        ((F.unix_micros(now) - F.unix_micros(started_at)) / 1e6).alias("elapsed"),
    )
    return (
        facts.withColumn("percent", done / target * 100)
        .withColumn("overall_rate", rate(done))
        .withColumn("session_rate", rate(done - existing))
        .withColumn("overall_hours_left", left(F.col("overall_rate")))
        .withColumn("session_hours_left", left(F.col("session_rate")))
    )


def report_points(log: DataFrame, started_at: Column | None = None, existing: int = 0) -> DataFrame:
    """Items at which a report is due, with ``sample`` where a sample line goes along.

    A report comes at every tenth item, or when the last report is more than half an hour
    old. Every tenth item starts the clock anew, so the time rule only needs the items since
    then: a group has at most ten rows.
    """
    counted = log.withColumn("n", F.col("item") + 1 + existing)
    tens = counted.groupBy(F.expr(f"n div {REPORT_ITEMS}").alias("ten")).agg(
        F.sort_array(F.collect_list(F.struct("n", F.unix_micros("finished_at").alias("at")))).alias("rows")
    )
    start = F.unix_micros(started_at) if started_at is not None else F.lit(None).cast("long")
    # the report that ends the previous ten is the first row of a group, except in the first group
    clock = F.when(F.col("rows")[0]["n"] % REPORT_ITEMS == 0, F.col("rows")[0]["at"]).otherwise(start)
    empty = F.struct(clock.alias("last"), F.array().cast("array<bigint>").alias("due"))

    def step(state: Column, row: Column) -> Column:
        due = (row["n"] % REPORT_ITEMS == 0) | F.coalesce(row["at"] - state["last"] > QUIET_SECONDS * 1_000_000, F.lit(False))
        return F.struct(
            F.when(due, row["at"]).otherwise(state["last"]).alias("last"),
            F.when(due, F.concat(state["due"], F.array(row["n"]))).otherwise(state["due"]).alias("due"),
        )

    due = tens.select(F.explode(F.aggregate("rows", empty, step, lambda s: s["due"])).alias("n"))
    return due.select("n", (F.col("n") % SAMPLE_ITEMS == 0).alias("sample"))


def resume_plan(existing: DataFrame, target: int) -> DataFrame:
    """One row: what exists and what is left to generate."""
    return existing.agg(F.count(F.lit(1)).alias("existing")).withColumn(
        "remaining", F.greatest(F.lit(0).cast("long"), target - F.col("existing"))
    )


def take_target(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of the columns ``order``, spread over the cluster."""
    return ordered_index(df, list(order), "_i").filter(F.col("_i") < n).drop("_i")


def stalls(log: DataFrame, ts: str = "ts", gap_seconds: int = QUIET_SECONDS) -> DataFrame:
    """Gaps of more than ``gap_seconds`` between consecutive rows.

    Rows are first reduced to one per window of that length. No gap fits inside a window, so
    the steps between windows show all of them, and their number follows the time covered.
    """
    micros = F.unix_micros(ts)
    windows = log.groupBy(F.floor(micros / (gap_seconds * 1_000_000)).alias("w")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    quiet_from = F.lag("last").over(W.orderBy("w"))
    return windows.select(quiet_from.alias("quiet_from"), F.col("first").alias("quiet_until")).filter(
        F.unix_micros("quiet_until") - F.unix_micros("quiet_from") > gap_seconds * 1_000_000
    )


def generate(
    requests: DataFrame, client: Callable[[], Client], retries: int = RETRIES, wait_seconds: float = WAIT_SECONDS,
    prompt: str = "prompt", out: str = "response", concurrency: int | None = None,
) -> DataFrame:
    """Ask a model for each row of a request table.

    ``client`` is called once per partition and returns the function that answers a prompt;
    the number of partitions therefore bounds the concurrency. A request that keeps failing
    gives an empty text.
    """
    source = requests.repartition(concurrency) if concurrency else requests
    schema = StructType([*source.schema.fields, StructField(out, StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()

        def answer(text: str) -> str:
            for attempt in range(1, retries + 1):
                try:
                    return ask(text) or ""
                except Exception:
                    if attempt < retries:
                        time.sleep(wait_seconds * attempt)
            return ""

        for batch in batches:
            yield batch.assign(**{out: [answer(t) for t in batch[prompt]]})

    return source.mapInPandas(run, schema)


def request_messages(system: Column, user: Column, reply: Column | None = None, tool_text: Column | None = None) -> Column:
    """Request payload: system and user, and for a continuation also the reply and the tool results."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    parts = [message("system", system), message("user", user)]
    if reply is not None:
        parts += [message("assistant", reply), message("user", tool_text)]
    return F.array(*parts)


def evaluate(prompts: DataFrame, models: dict[str, Callable[[], Client]], pos: str = "question_no", **options) -> DataFrame:
    """Each question to each model: ``(question_no, prompt, model, response)``."""
    names = F.array(*[F.lit(m) for m in sorted(models)])
    requests = prompts.select(pos, "prompt", F.explode(names).alias("model"))
    makers = dict(models)

    def client() -> Client:
        ready: dict[str, Client] = {}

        def ask(packed: str) -> str:
            model, text = packed.split("\x00", 1)
            if model not in ready:
                ready[model] = makers[model]()
            return ready[model](text)

        return ask

    packed = requests.withColumn("_packed", F.concat_ws("\x00", "model", "prompt"))
    return generate(packed, client, prompt="_packed", **options).select(pos, "prompt", "model", "response")


def metric_series(log: DataFrame, pos: str = "step", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Training-log rows as ``(step, epoch, metric, value)`` with defaults filled in.

    A missing epoch is the number of the row, other missing values are 0. The gradient-norm
    series only appears if one of its values is not 0.
    """
    rows = scan(
        log, [], pos, before={"_row": F.lit(1).cast("long")},
        max_all={"_norms": (F.coalesce("grad_norm", F.lit(0.0)) != 0).cast("int")}, block_rows=block_rows,
    )
    filled = rows.select(
        pos, F.coalesce("epoch", F.col("_row").cast("double")).alias("epoch"), "_norms",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("loss", "lr", "grad_norm")],
    )
    long = filled.select(
        pos, "epoch", "_norms", F.expr("stack(3, 'loss', loss, 'lr', lr, 'grad_norm', grad_norm) as (metric, value)")
    )
    return long.filter("metric <> 'grad_norm' or _norms = 1").drop("_norms")


def validation_preview(rows: DataFrame, client: Callable[[], Client], decoder, **options) -> DataFrame:
    """The first example of an evaluation set, decoded, with a model's answer to it."""
    first = rows.orderBy("idx").limit(1).select("idx", decoder(F.col("input_ids")).alias("prompt"))
    return generate(first, client, **options)
