from pyspark.sql import functions as F

from dialogprep.operators.runs import stalls
from dialogprep.streaming.ingest import save_batch, stalls_between, stalls_stream, stored_conversations, worker_counters

LOG = "worker_id int, item long, conv_id long"


def test_a_repeated_batch_neither_skips_nor_repeats_numbers(spark, tmp_path):
    out = str(tmp_path / "saved")
    first = spark.createDataFrame([(i % 2, i, 100 + i) for i in range(5)], LOG)
    second = spark.createDataFrame([(i % 2, i, 100 + i) for i in range(5, 12)], LOG)
    save_batch(first, 0, out, target=10)
    save_batch(second, 1, out, target=10)
    save_batch(second, 1, out, target=10)
    save_batch(first.limit(0), 2, out, target=10)
    rows = stored_conversations(spark, out).orderBy("n").collect()
    assert [(r.n, r.id, r.conv_id) for r in rows] == [(i + 1, f"conv_{i + 1:06d}", 100 + i) for i in range(10)]
    assert {r.worker_id: r.stored for r in worker_counters(spark, out).collect()} == {0: 5, 1: 5}


def test_stalls_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    minutes = [0, 5, 29, 31, 70, 71, 72, 160, 190, 190, 221]
    df = spark.createDataFrame(list(enumerate(minutes)), "i int, m int").select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins="m")).alias("ts")
    )
    df.write.parquet(str(tmp_path / "events"))
    windows = stalls_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "events")))
    run = windows.writeStream.outputMode("complete").format("memory").queryName("activity").trigger(availableNow=True).start()
    run.awaitTermination()
    found = sorted(map(tuple, stalls_between(spark.table("activity")).collect()))
    assert found == sorted(map(tuple, stalls(df).collect()))
    assert [((b - a).total_seconds() / 60) for a, b in found] == [39, 88, 31]


def test_a_new_run_goes_on_where_the_last_one_ended(spark, tmp_path):
    out = str(tmp_path / "saved")
    part = lambda a, b: spark.createDataFrame([(0, i, 100 + i) for i in range(a, b)], LOG)
    save_batch(part(0, 2), 0, out, run="one", existing=40)
    save_batch(part(2, 3), 0, out, run="two")
    save_batch(part(2, 3), 0, out, run="two")
    rows = stored_conversations(spark, out).orderBy("n").collect()
    assert [(r.n, r.conv_id) for r in rows] == [(41, 100), (42, 101), (43, 102)]
