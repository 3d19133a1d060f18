"""Exact duplicates with skew-safe combining, in DataFrame functions only.

1. Locally: every task merges its rows of equal text (the map side of the first aggregation).
2. By salt: what is left of a text meets in one of ``SALTS`` groups of its digest, by the row's id.
   A text that a third of all rows share is so merged in ``SALTS`` tasks of a few rows each.
3. Globally: the winners of all salts of a text meet, at most ``SALTS`` rows for each text.

Each of the three steps groups by the full text next to its digest, so texts whose digests collide
stay apart. Rows find their group by digest and salt; where one digest has several texts, by the
text as well. Rows are narrow there, and a hot digest is again spread over its salts.

A null text counts as empty, and all empty texts are equal. Very long texts are compared whole. The
row with the largest id stays; rows that share that id all do. Rows without an id never stay if
their text stands in a row that has one, else all of them stay and ``keep_id`` is null. Repeated rows
count as often as they occur. An empty table gives an empty result. Other columns are not read by
``groups_of``; ``kept_rows`` passes them through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.session import durable

SALTS = 64


def as_is(text: Column) -> Column:
    """Texts are equal when they are identical."""
    return text


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _rows(docs: DataFrame, id: str, text: str, normalise: Callable, digest: Callable, salts: int) -> DataFrame:
    """``(id, digest, salt, content)`` of every row."""
    content = normalise(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id).alias("id"), content.alias("content"))
    return rows.select("id", digest(F.col("content")).alias("digest"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"), "content")


def _winners(rows: DataFrame) -> DataFrame:
    """``(digest, content, keep_id, size)`` of every text, laid out by digest."""
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    return salted.repartition("digest").groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))


def groups_of(
    docs: DataFrame, id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = as_is,
    digest: Callable[[Column], Column] = sha256, salts: int = SALTS,
) -> DataFrame:
    """``(id, digest, keep_id, size)`` of every row: who stays of its group, and how large that is."""
    rows = _rows(docs, id, text, normalise, digest, salts)
    known = durable(rows.select("id", "digest", "salt"), "digests")
    # the second aggregation finds its rows laid out by digest already
    per = _winners(rows).groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("size").alias("size"))
    per = durable(per.filter("texts > 1 or size > 1"), "groups")
    alike = per.filter("texts = 1").drop("texts")
    # a digest's group reaches its rows over the salts it occurs in
    spread = known.select("digest", "salt").distinct().join(alike, "digest")
    lone = F.struct(F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("size"))
    group = F.when(F.col("size").isNotNull(), F.struct("keep_id", "size")).otherwise(lone)
    collided = per.filter("texts > 1").select("digest")
    if collided.isEmpty():
        return known.join(spread, ["digest", "salt"], "left").select("id", "digest", group.alias("g")).select("id", "digest", "g.keep_id", "g.size")
    found = known.join(collided, "digest", "left_anti").join(spread, ["digest", "salt"], "left").select("id", "digest", group.alias("g"))
    unsure = rows.join(collided, "digest", "left_semi")
    texts = durable(_winners(unsure), "collided")
    salted = unsure.select("digest", "salt", "content").distinct().join(texts, ["digest", "content"])
    apart = unsure.join(salted, ["digest", "salt", "content"]).select("id", "digest", F.struct("keep_id", "size").alias("g"))
    return found.unionByName(apart).select("id", "digest", "g.keep_id", "g.size")


def stays(id: Column, keep_id: Column) -> Column:
    """Whether a row is one that its group keeps."""
    return keep_id.isNull() | F.coalesce(id == keep_id, F.lit(False))


def kept_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = as_is) -> DataFrame:
    """``docs`` without the rows that another row of equal text stands for."""
    found = groups_of(docs, id, text, normalise)
    gone = found.filter(~stays(F.col("id"), F.col("keep_id"))).select("id", "digest").distinct()
    content = normalise(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), sha256(content).alias("digest"))
    return rows.join(gone, rows["id"].eqNullSafe(gone["id"]) & (rows["digest"] == gone["digest"]), "left_anti").select("row.*")
