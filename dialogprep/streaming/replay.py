"""The store kept up to date from a stream of tool calls.

Each micro-batch runs the same distributed replay as a batch job, so a user or diary with a
large share of the calls is split as there. Batch ``n`` writes the lists it touched, and only
those, below its own number; the current state of a list is what the last batch that touched
it wrote. Every ``compact_every`` batches all lists are written, so a batch never looks back
further than that. A repeated batch reads what came before it and overwrites its own files, so
it gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dialogprep.operators.store import ENTRY_COLUMNS, list_of_call, replay
from dialogprep.session import durable
from dialogprep.streaming.steps import next_step, query_of

_LIST = ["kind", "owner"]
COMPACT_EVERY = 50


def _meta(spark: SparkSession, path: str, batch_id: int) -> tuple[int, dict[str, int]]:
    """First batch to look at, and the last id used per kind (three rows at most)."""
    rows = spark.read.parquet(f"{path}/meta/batch={batch_id}").collect()
    return rows[0]["base"], {r["kind"]: r["last_id"] for r in rows if r["kind"] is not None}


def _state(spark: SparkSession, path: str, base: int, upto: int, lists: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries as of batch ``upto``, and the lists they belong to."""
    span = F.col("batch").between(base, upto)
    written = spark.read.parquet(f"{path}/lists").filter(span)
    if lists is not None:
        written = written.join(lists, _LIST, "left_semi")
    latest = written.groupBy(*_LIST).agg(F.max("batch").alias("batch"))
    entries = spark.read.parquet(f"{path}/entries").filter(span).join(latest, [*_LIST, "batch"], "left_semi")
    return entries.select(*ENTRY_COLUMNS), latest.select(*_LIST)


def apply_batch(
    calls: DataFrame, batch_id: int, path: str, diary_owner: str | None = None, compact_every: int = COMPACT_EVERY,
    run: str | None = None, **options
) -> None:
    """Fold one micro-batch into the store below ``path``.

    Batches of all runs form one sequence, so a new run (another checkpoint) goes on with the
    store as it is. One run at a time may write to a path.
    """
    spark = calls.sparkSession
    run_batch, run = batch_id, run or query_of(spark)
    batch_id = next_step(spark, f"{path}/meta", run, run_batch)
    calls = durable(calls, "calls")
    kind, owner = list_of_call(diary_owner)
    touched = calls.select(kind.alias("kind"), owner.alias("owner")).filter("kind is not null").distinct()
    base, last_ids, state, untouched = batch_id, {}, None, None
    if batch_id > 0:
        base, last_ids = _meta(spark, path, batch_id - 1)
        if batch_id % compact_every == 0:
            everything, lists = _state(spark, path, base, batch_id - 1)
            untouched = everything.join(touched, _LIST, "left_anti")
            state, base = everything.join(touched, _LIST, "left_semi"), batch_id
            touched = touched.unionByName(lists).distinct()
        else:
            state, _ = _state(spark, path, base, batch_id - 1, touched)
    done = replay(calls, state=state, diary_owner=diary_owner, start_ids=last_ids, **options)
    entries = done.entries if untouched is None else done.entries.unionByName(untouched)
    entries.write.mode("overwrite").parquet(f"{path}/entries/batch={batch_id}")
    touched.write.mode("overwrite").parquet(f"{path}/lists/batch={batch_id}")
    done.outcomes.write.mode("overwrite").parquet(f"{path}/outcomes/batch={batch_id}")
    known = spark.createDataFrame([*last_ids.items(), (None, 0)], "kind string, last_id long")
    used = done.lifetimes.groupBy("kind").agg(F.max("entry_id").alias("last_id")).unionByName(known)
    used.groupBy("kind").agg(F.max("last_id").alias("last_id")).withColumns(
        {"base": F.lit(base), "run": F.lit(run), "run_batch": F.lit(run_batch).cast("long")}
    ).write.mode("overwrite").parquet(
        f"{path}/meta/batch={batch_id}"
    )


def replay_stream(calls: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Start the query. ``trigger`` is what ``DataStreamWriter.trigger`` takes; by default it ends with the available input."""
    return (
        calls.writeStream.foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, path, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries after the last batch."""
    last = spark.read.parquet(f"{path}/meta").agg(F.max("batch").alias("b")).first()["b"]
    base, _ = _meta(spark, path, last)
    return _state(spark, path, base, last)[0]


def all_outcomes(spark: SparkSession, path: str) -> DataFrame:
    finished = spark.read.parquet(f"{path}/meta").select("batch").distinct()
    return spark.read.parquet(f"{path}/outcomes").join(finished, "batch", "left_semi")
