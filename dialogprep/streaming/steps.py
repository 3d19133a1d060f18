"""One sequence of steps for all runs that write to a path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def query_of(spark: SparkSession) -> str:
    """The streaming query that runs just now; it keeps its name as long as it keeps its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def next_step(spark: SparkSession, log: str, run: str, run_batch: int) -> int:
    """The step of a run's batch: one behind the last step in ``log`` that isn't this batch's own earlier attempt.

    ``log`` has a folder ``batch=<step>`` for each finished step, with columns ``run`` and ``run_batch``.
    """
    try:
        done = spark.read.parquet(log)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise
    own = (F.col("run") == run) & (F.col("run_batch") >= run_batch)
    last = done.filter(~own).agg(F.max("batch")).first()[0]
    return 0 if last is None else last + 1
