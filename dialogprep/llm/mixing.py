"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Every source gets a share of the training tokens by weight, at most ``most`` times its own size
(the excess goes to the others by weight). Its weight also changes over training time: a schedule
of ``(time, weight)`` knots, linear in between. Integrated and scaled to the source's target, the
schedule is the source's cumulative demand for tokens. The source's documents are laid end to end
in seeded order, once per epoch; the place where a copy begins, put through the inverse of that
demand, is its position in training. Sorting by range of position gives the training order.

The copy that reaches the target is cut there, so a source's taken words equal its target, rounded
down. Running sums go by (source, hash bucket), so a source with a third of all rows is spread
over thousands of windows; only bucket totals meet per source. Rows of equal id and text are
interchangeable, and equal ids with different texts are ordered by size. A null source is a source
of its own and the last; a null or empty text has size 0 and is taken 0 times. A very long text is
counted and taken like any other. An empty table gives an empty mix. Other columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.operators.order import seeded_hash
from dialogprep.session import durable

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20240
#: Per source in turn: steady, early, late.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)), ((0.0, 0.5), (1.0, 2.0)))
_BUCKET_DIGITS = 3


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, rank, source_size, target)``, one row per source of ``sizes(source, size)``.

    Sources fill up in the order of the level at which they reach ``most`` times their size. The
    level of all others is what is left over their weight, from the first source on that stays below.
    """
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights))
    per = per.withColumn("w", weight).withColumn("full", F.col("source_size") / F.col("w"))
    earlier = W.orderBy("full", "rank").rowsBetween(W.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    per = per.withColumn("level", left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0))))
    below = F.when(F.col("level") <= most * F.col("full"), F.struct("full", "rank", "level"))
    level = F.min(below).over(everything)["level"]
    cap = F.col("source_size").cast("double") * most
    return per.withColumn("target", F.coalesce(F.least(level * F.col("w"), cap), cap)).select("source", "rank", "source_size", "target")


def _segments(knots: Sequence[tuple[float, float]]) -> Column:
    """Pieces of a schedule as ``(c, t, w, slope, area)``: share of demand before, start, weight, slope; ``area`` is the whole integral."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, done, out = sum(areas), 0.0, []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        values = {"c": done / total, "t": t0, "w": w0, "slope": (w1 - w0) / (t1 - t0), "area": total}
        out.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in values.items()]))
        done += area
    return F.array(*out)


def time_of(share: Column, rank: Column, schedules: Sequence = SCHEDULES) -> Column:
    """The time at which a source has met ``share`` of its demand."""
    chosen = F.get(F.array(*map(_segments, schedules)), rank % len(schedules))
    piece = F.element_at(F.filter(chosen, lambda s: s["c"] <= share), -1)
    area = (share - piece["c"]) * piece["area"]
    root = F.sqrt(F.greatest(piece["w"] * piece["w"] + 2 * area * piece["slope"], F.lit(0.0)))
    return F.when(area > 0, F.least(piece["t"] + 2 * area / (piece["w"] + root), F.lit(1.0))).otherwise(piece["t"])


def planned(sized: DataFrame, id: str = "doc_id", seed: int = SEED, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            most: float = MOST, schedules: Sequence = SCHEDULES, ties: Sequence[str] = ()) -> DataFrame:
    """Add ``source_size``, ``target``, ``taken`` and ``copies`` to rows with ``source`` and ``size``.

    ``copies`` lists ``(epoch, words, position)`` of every copy that the mix takes. ``ties`` names further
    columns that order rows of equal id and size.
    """
    goals = source_targets(sized.select("source", "size"), weights, share, most)
    rows = sized.drop("source_size", "target", "taken", "copies", "rank").withColumn("_h", seeded_hash(seed, F.coalesce(F.col(id).cast("string"), F.lit("")))).withColumn(
        "_b", F.substring("_h", 1, _BUCKET_DIGITS))
    totals = rows.groupBy("source", "_b").agg(F.sum("size").alias("_t"))
    along = W.partitionBy("source").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("_s"), F.col("_b").alias("_ob"), F.coalesce(F.sum("_t").over(along), F.lit(0)).alias("_off"))
    goals = goals.withColumnRenamed("source", "_gs")
    offsets = offsets.join(goals, F.col("_s").eqNullSafe(F.col("_gs"))).drop("_gs")
    inside = W.partitionBy("source", "_b").orderBy("_h", id, "size", *ties).rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_ob")))
    goal = F.floor("target")
    epochs = F.sequence(F.lit(0), F.lit(max(0, -int(-most // 1) - 1)))
    start = lambda e: e * F.col("source_size") + F.col("_off") + F.col("_in")
    words = lambda e: F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - start(e)))
    every = F.transform(epochs, lambda e: F.struct(e.alias("epoch"), words(e).alias("words"), time_of(F.coalesce(F.try_divide(start(e), F.col("target")), F.lit(0.0)), F.col("rank"), schedules).alias("position")))
    out = placed.withColumn("copies", F.filter(every, lambda c: c["words"] > 0))
    out = out.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
    return out.drop("_h", "_b", "_s", "_ob", "_off", "_in", "rank")


def mixed(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: one row per copy, sorted by training position.

    The copy in which a source reaches its target is passed whole. The plan is made on ids, sources,
    sizes and check sums; texts join it once and are sorted once. Of rows with equal id, source and text
    the first one stands for all of them, and is taken as often as all of them are.
    """
    key = [F.col(id).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("content")]
    sized = durable(docs.select(*key, size_of(F.col(text)).alias("size")), "sizes")
    copies = planned(sized, ties=["content"], **{"id": "id", **options}).select("id", "source", "content", F.explode("copies").alias("c"))
    copies = durable(copies.select("id", "source", "content", "c.position", "c.epoch"), "copies")
    same = lambda a, b: a["id"].eqNullSafe(b["id"]) & a["source"].eqNullSafe(b["source"]) & (a["content"] == b["content"])
    rows = docs.select(F.struct("*").alias("row"), *key)
    twice = durable(sized.groupBy("id", "source", "content").count().filter("count > 1").drop("count"), "twice")
    if not twice.isEmpty():
        one = rows.join(twice, same(rows, twice), "left_semi").groupBy("id", "source", "content").agg(F.min_by("row", F.to_json("row")).alias("row"))
        rows = rows.join(twice, same(rows, twice), "left_anti").unionByName(one)
    taken = rows.join(copies, same(rows, copies)).select("row", copies["id"], "position", "epoch")
    return taken.orderBy("position", "id", "epoch").select("row.*")
