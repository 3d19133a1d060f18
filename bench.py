"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "read_message_log", "segment_at_reply", "complete_conversations", "transcript", "followup_prompt", "assemble_reply",
    "tool_calls", "replay_entries", "replay_outcomes", "recall_memories", "batch_update_memory", "sample_exact", "shuffle_pool",
    "build_megachats", "encode_examples", "prepare_dataset", "pad_batches", "generate", "stalls", "metric_series",
)


def main() -> None:
    from dialogprep.catalog import all_queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("role").count().collect()  # start the engine
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
