"""Writers. Conversations are written in long form, so one long conversation is many rows."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, metadata: dict, key: str = "id", fmt: str = "parquet") -> None:
    """Write conversations to ``path/conversations`` and a one-row ``path/metadata``.

    ``num_examples`` is counted while writing and never passes through the driver.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path}/conversations")
    fields = [F.lit(json.dumps(v) if isinstance(v, (dict, list)) else v).alias(k) for k, v in metadata.items()]
    written = df.sparkSession.read.schema(df.schema).format(fmt).load(f"{path}/conversations")
    count = written.select(key).distinct().agg(F.count(F.lit(1)).alias("num_examples"))
    count.select(*fields, "num_examples").write.mode("overwrite").json(f"{path}/metadata")


def append_conversations(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Add conversations to an output; earlier files are not touched."""
    df.write.mode("append").format(fmt).save(path)


def write_message_arrays(df: DataFrame, path: str, keys: Sequence[str] = ("conv_id",), field: str = "conversations") -> None:
    """Interchange form: one JSON object per conversation with its messages as an array.

    One conversation is one value of this format. Use the long form where conversations can
    be of any length.
    """
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "role", "content"))),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    df.groupBy(*keys).agg(ordered.alias(field)).write.mode("append").json(path)


def fingerprint(params: dict) -> str:
    return hashlib.md5(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], params: dict, force_rebuild: bool = False) -> DataFrame:
    """The table built for ``params``, from ``path`` when a finished one is there."""
    place = f"{path.rstrip('/')}/{fingerprint(params)}"
    if not force_rebuild:
        try:
            newest = spark.read.schema("run string, written double").parquet(f"{place}/manifest").agg(F.max_by("run", "written")).first()[0]
            if newest is not None:
                return spark.read.parquet(f"{place}/{newest}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    run = f"run-{uuid.uuid4().hex}"
    build().write.parquet(f"{place}/{run}")
    # last: only what the manifest names is ever read, so a build that broke off isn't
    spark.createDataFrame([(run, time.time())], "run string, written double").coalesce(1).write.mode("append").parquet(f"{place}/manifest")
    return spark.read.parquet(f"{place}/{run}")
