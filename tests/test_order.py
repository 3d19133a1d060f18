import random

from pyspark.sql import functions as F

from dialogprep.operators.order import global_index, ordered_index, scan, spread_range


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]


def test_global_index_is_dense_and_independent_of_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one = rows(global_index(df, 7, ["k"], "i"), "k", "i")
    many = rows(global_index(df.repartition(13), 7, ["k"], "i", prefix=1), "k", "i")
    other = rows(global_index(df, 8, ["k"], "i"), "k", "i")
    assert one == many and one != other
    assert sorted(i for _, i in one) == list(range(500))


def test_ordered_index_follows_the_order_with_one_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("a"), F.col("id").alias("b"))
    got = rows(ordered_index(df.repartition(6), ["a", "b"], "i"), "i", "a", "b")
    assert [g[0] for g in got] == list(range(3000))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_scan_matches_a_plain_loop_across_blocks(spark):
    rng = random.Random(1)
    data = [(k, p, rng.randint(0, 3)) for k, n in (("hot", 400), ("b", 30), ("c", 1)) for p in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, p long, v long")
    out = scan(
        df, ["k"], "p", before={"bef": F.col("v")}, after={"aft": F.col("v")},
        max_before={"top": F.col("v") * 1000 + F.col("p")}, max_all={"all": F.col("v")}, block_rows=16,
    )
    by_key = {}
    for k, p, v in sorted(data):
        by_key.setdefault(k, []).append(v)
    want = []
    for k, vs in by_key.items():
        for p, v in enumerate(vs):
            top = max((x * 1000 + i for i, x in enumerate(vs[:p])), default=None)
            want.append((k, p, sum(vs[:p]), sum(vs[p + 1:]), top, max(vs)))
    assert rows(out, "k", "p", "bef", "aft", "top", "all") == sorted(want)


def test_scan_without_keys(spark):
    df = spark.range(1000).withColumnRenamed("id", "p").repartition(5)
    out = scan(df, [], "p", before={"n": F.lit(1).cast("long")}, block_rows=32)
    assert rows(out, "p", "n") == [(i, i) for i in range(1000)]


def test_spread_range(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 1), ("c", 257)], "k string, n long")
    got = rows(spread_range(counts, ["k"], "n", "d", chunk=50), "k", "d")
    assert got == [("b", 0)] + [("c", i) for i in range(257)]
