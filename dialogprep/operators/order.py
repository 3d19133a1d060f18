"""Order-dependent building blocks that hold up when one key has a large share of the rows.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. The functions here cut a key
into blocks of bounded size, work inside the blocks, and carry small per-block totals across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.session import durable

BLOCK_ROWS = 65_536
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these bits


def seeded_hash(seed: int | str, *keys: str | Column) -> Column:
    """md5 of ``seed|key|...`` as 32 hex digits: the source of all reproducible randomness."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def global_index(
    df: DataFrame, seed: int | str, keys: Sequence[str], out: str, within: Sequence[str] = (), prefix: int = 3
) -> DataFrame:
    """Add ``out``: the 0-based place of each row in the order of ``seeded_hash(seed, *keys)``.

    With ``within``, places are counted inside each group. Rows are bucketed on the leading
    hash digits, which spread evenly whatever the data looks like. The per-bucket counts, at
    most 16**prefix rows for each group, give the offsets.
    """
    within = list(within)
    hashed = df.withColumn("_h", seeded_hash(seed, *keys)).withColumn("_b", F.substring("_h", 1, prefix))
    counts = hashed.groupBy(*within, "_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*within).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*within, "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    if not within:
        offsets = F.broadcast(offsets)  # at most 16**prefix rows
    inside = W.partitionBy(*within, "_b").orderBy("_h", *keys)
    return (
        hashed.join(offsets, [*within, "_b"])
        .withColumn(out, F.col("_off") + F.row_number().over(inside) - 1)
        .drop("_h", "_b", "_off")
    )


def ordered_index(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the 0-based dense place of each row in the order of the columns ``order``.

    The columns together must be unique. Rows are range-partitioned, so equal leading values
    are split over partitions too; the result is written once, because a second run of the
    range exchange could draw other boundaries.
    """
    ranged = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("_at", _ROW_BITS)
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per shuffle partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_off") + row)
        .drop("_at", "_part", "_off")
    )


def scan(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
    max_before: dict[str, Column] | None = None,
    max_all: dict[str, Column] | None = None,
    block: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running aggregates along ``pos`` inside ``keys``.

    ``before`` and ``after`` sum an expression over the rows strictly before or after the
    current one, ``max_before`` takes the maximum over the rows strictly before it, and
    ``max_all`` the maximum over the whole key. ``pos`` is an integer that is unique in its
    key, so a block of ``block_rows`` consecutive values holds at most that many rows. Callers
    with an order of their own pass ``block``, which must rise with ``pos``.

    Only keys that reach into a second block take part in the carry join.
    """
    before, after = before or {}, after or {}
    max_before, max_all = max_before or {}, max_all or {}
    sums = {**before, **after}
    tops = {**max_before, **max_all}
    keys = list(keys)
    block = F.expr(f"`{pos}` div {block_rows}") if block is None else block
    blocked = df.withColumn("_blk", block)

    totals = blocked.groupBy(*keys, "_blk").agg(
        *[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_t_{n}") for n, e in tops.items()],
    )
    along = W.partitionBy(*keys).orderBy("_blk")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    carried = []
    for n in before:
        carried.append(F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}"))
    for n in after:
        upto = along.rowsBetween(W.unboundedPreceding, 0)
        carried.append((F.sum(f"_t_{n}").over(whole) - F.sum(f"_t_{n}").over(upto)).alias(f"_c_{n}"))
    for n in max_before:
        carried.append(F.max(f"_t_{n}").over(earlier).alias(f"_c_{n}"))
    for n in max_all:
        carried.append(F.max(f"_t_{n}").over(whole).alias(f"_c_{n}"))
    carry = (
        totals.select(*keys, "_blk", *carried, F.count(F.lit(1)).over(whole).alias("_blocks"))
        .filter("_blocks > 1")
        .drop("_blocks")
    )

    inside = W.partitionBy(*keys, "_blk").orderBy(pos)
    so_far = inside.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(*keys, "_blk")
    local = {}
    for n, e in before.items():
        local[f"_l_{n}"] = F.coalesce(F.sum(e).over(so_far), F.lit(0))
    for n, e in after.items():
        local[f"_l_{n}"] = F.sum(e).over(everything) - F.coalesce(F.sum(e).over(so_far), F.lit(0)) - e
    for n, e in max_before.items():
        local[f"_l_{n}"] = F.max(e).over(so_far)
    for n, e in max_all.items():
        local[f"_l_{n}"] = F.max(e).over(everything)
    joined = blocked.withColumns(local).join(carry, [*keys, "_blk"], "left")
    out = {n: F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in sums}
    out |= {n: F.greatest(F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n in tops}
    return joined.withColumns(out).select(*df.columns, *out)


def spread_range(counts: DataFrame, keys: Sequence[str], n: str, out: str, chunk: int = 100_000) -> DataFrame:
    """Rows ``0 .. n-1`` for each row of ``counts``, made in parallel.

    One row first becomes one row per ``chunk``; those are spread over the cluster before each
    is expanded, so a large count does not grow inside a single task.
    """
    keys = list(keys)
    chunks = counts.filter(F.col(n) > 0).select(
        *keys,
        F.col(n).cast("long").alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(cast(`{n}` as bigint) - 1) div {chunk}"))).alias("_c"),
    )
    first = F.col("_c") * chunk
    last = F.least(first + chunk, F.col("_n")) - 1
    return chunks.repartition(*keys, "_c").select(*keys, F.explode(F.sequence(first, last)).alias(out))
