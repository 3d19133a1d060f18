"""Where intermediate results go so that a lost executor costs a re-read, not a re-run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables, else one below the warehouse.

    Both are shared by all executors; no machine's own temporary folder is ever used.
    """
    named = spark.conf.get(_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "step", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and carry on from the written table.

    This cuts the lineage, fixes values such as ``monotonically_increasing_id`` for good, and
    stops a plan from computing the same input once per branch. Wide tables name a
    ``compression`` other than the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``max_rows`` rows.

    A larger one goes without the hint, and the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
