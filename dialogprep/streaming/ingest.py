"""Saving conversations as concurrent workers deliver them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dialogprep.operators.order import ordered_index
from dialogprep.operators.runs import QUIET_SECONDS
from dialogprep.streaming.steps import next_step, query_of


def save_batch(arrived: DataFrame, batch_id: int, path: str, target: int | None = None, run: str | None = None, existing: int = 0) -> None:
    """Number and store the conversations ``(worker_id, item, conv_id, ...)`` of one micro-batch.

    Batches of all runs on ``path`` form one sequence; numbers continue from the step before, or
    from ``existing`` where nothing is stored yet. A repeated batch takes its own step again, so it
    neither skips nor repeats numbers, and a new run (another checkpoint) never touches an earlier
    one's steps. Nothing is stored beyond ``target``. One run at a time may write to a path.
    """
    spark = arrived.sparkSession
    run = run or query_of(spark)
    step = next_step(spark, f"{path}/counters", run, batch_id)
    before = spark.read.parquet(f"{path}/counters/batch={step - 1}").agg(F.max("total")).first()[0] if step else existing
    numbered = ordered_index(arrived, ["item", "worker_id"], "_i").withColumn("n", F.col("_i") + before + 1).drop("_i")
    if target is not None:
        numbered = numbered.filter(F.col("n") <= target)
    kept = numbered.withColumn("id", F.format_string("conv_%06d", F.col("n")))
    kept.write.mode("overwrite").parquet(f"{path}/conversations/batch={step}")
    stored = spark.read.parquet(f"{path}/conversations/batch={step}")
    counters = stored.groupBy("worker_id").agg(F.count(F.lit(1)).alias("stored"))
    total = stored.agg((F.count(F.lit(1)) + before).alias("total"))
    # one row per worker, and always at least one row to carry the total
    total.withColumn("_one", F.lit(1)).join(counters.withColumn("_one", F.lit(1)), "_one", "left").drop("_one").withColumns(
        {"run": F.lit(run), "run_batch": F.lit(batch_id).cast("long")}
    ).write.mode("overwrite").parquet(f"{path}/counters/batch={step}")


def ingest_stream(
    source: DataFrame, path: str, checkpoint: str, target: int | None = None, trigger: dict | None = None, existing: int = 0
) -> StreamingQuery:
    """Start the query. ``trigger`` is what ``DataStreamWriter.trigger`` takes; by default it ends with the available input."""
    return (
        source.writeStream.foreachBatch(lambda df, batch_id: save_batch(df, batch_id, path, target, existing=existing))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_conversations(spark: SparkSession, path: str) -> DataFrame:
    """All conversations of finished steps."""
    finished = spark.read.parquet(f"{path}/counters").select("batch").distinct()
    return spark.read.parquet(f"{path}/conversations").join(finished, "batch", "left_semi").drop("batch")


def worker_counters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/counters").filter("worker_id is not null").groupBy("worker_id").agg(
        F.sum("stored").alias("stored")
    )


def stalls_stream(events: DataFrame, ts: str = "ts", gap_seconds: int = QUIET_SECONDS, lateness: str = "1 hour") -> DataFrame:
    """Activity windows of a stream, one row per window of the gap's length.

    Consecutive rows of the result that lie more than the gap apart are stalls; a window is
    emitted once the watermark has passed it. ``stalls`` gives the same answer on a table.
    """
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{gap_seconds} seconds"))
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
        .select("first", "last")
    )


def stalls_between(windows: DataFrame, gap_seconds: int = QUIET_SECONDS) -> DataFrame:
    """Stalls from the emitted windows: few rows, one per window with any activity."""
    from pyspark.sql.window import Window as W

    steps = windows.select(F.lag("last").over(W.orderBy("first")).alias("quiet_from"), F.col("first").alias("quiet_until"))
    return steps.filter(F.unix_micros("quiet_until") - F.unix_micros("quiet_from") > gap_seconds * 1_000_000)
