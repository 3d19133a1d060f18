from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dialogprep.llm import mixing
from tests.llm.cases import documents, empty, texts


def fill(sizes, weights, share=1.5, most=2):
    """Targets by resharing step by step."""
    total, full, target = share * sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and w and left * weights[s] / w > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else left * weights[s] / w for s in sizes}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, "d": 5}, {"a": 7}, {"a": 0, "b": 3}, {"a": 100, "b": 100, "c": 100}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    want = fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))})
    assert got == pytest.approx(want)


def plan(spark, rows):
    docs = documents(spark, rows, clash=["taken", "target"])
    return mixing.planned(docs.select("doc_id", "source", "taken", "target", mixing.size_of(F.col("text")).alias("size")))


def test_taken_words_reach_the_target(spark):
    rows = plan(spark, texts()).collect()
    assert len(rows) == len(texts())
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies)
    assert None in target
    for s in target:
        assert taken[s] == int(target[s])
    assert sorted(map(str, rows)) == sorted(map(str, plan(spark, texts()[::-1]).collect()))


def test_positions_follow_the_schedule(spark):
    early = (((0.0, 3.0), (1.0, 1.0)),)
    got = spark.range(11).select(mixing.time_of(F.col("id") / 10, F.lit(0), early).alias("t")).collect()
    # the integral of 3 - 2t, scaled to one, is (3t - t^2) / 2
    assert [(3 * r.t - r.t**2) / 2 for r in got] == pytest.approx([k / 10 for k in range(11)])
    steps = (((0.0, 1.0), (0.5, 1.0), (0.5001, 0.0), (1.0, 2.0)),)
    times = [r.t for r in spark.range(101).select(mixing.time_of(F.col("id") / 100, F.lit(0), steps).alias("t")).orderBy("id").collect()]
    assert times == sorted(times) and times[0] == 0 and times[-1] == pytest.approx(1)


def test_mixed_repeats_rows_in_order(spark):
    docs = documents(spark, clash=["size", "copies", "_h"])
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = sum(len(r.copies) for r in plan(spark, texts()).collect())
    assert out.count() == want
    assert mixing.mixed(empty(spark)).count() == 0
    nothing = mixing.mixed(documents(spark, [(1, None, "en", None), (2, "", "en", "a")]))
    assert nothing.count() == 0
