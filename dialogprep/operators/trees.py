"""Block summaries of one list, combined as a tree whose nodes are rows, for lists too long for one group.

The blocks of a list are the leaves of a binary tree. What a node does to the list it starts from is
a set of places, and two neighbours combine by one question: which is the n-th place that the left
one leaves free? Sorting the left one's places by the free places below them together with the
numbers asked for turns that into a running count, so a level is one range exchange and one
``scan`` whatever a node's size is. No array, task or group grows with a list. Every level is
written, and a list of ``b`` blocks takes about ``log2(b)`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.order import BLOCK_ROWS, ordered_index, scan
from dialogprep.session import broadcast_small, durable

NODE = ["list_key", "node"]
MAX_BROADCAST_NODES = 100_000


def _free_places(taken: DataFrame, asked: DataFrame, block_rows: int) -> DataFrame:
    """``taken`` and ``asked`` as ``(*NODE, place, rank, asked, ...)``, where asking for ``n`` gives the n-th free place.

    ``taken`` is ``(*NODE, place, rank, ...)`` with 1-based places and their ranks in a node, ``asked`` is
    ``(*NODE, n, ...)`` with different ``n`` in a node. ``rank`` of the result counts both.
    """
    more = [c for c in asked.columns if c not in (*NODE, "n")]
    rows = taken.select(*NODE, (F.col("place") - F.col("rank")).alias("_free"), F.lit(1).alias("_taken"), "place", *more).unionByName(
        asked.select(*NODE, F.col("n").alias("_free"), F.lit(0).alias("_taken"), F.lit(None).cast("long").alias("place"), *more)
    )
    # A taken place with fewer free ones below it than n stands before the n-th free place.
    numbered = ordered_index(rows, [*NODE, "_free", "_taken", "place"], "_pos")
    counted = scan(numbered, NODE, "_pos", before={"_below": F.col("_taken"), "_all": F.lit(1)}, block_rows=block_rows)
    place = F.coalesce("place", F.col("_free") + F.col("_below")).cast("long").alias("place")
    return durable(
        counted.select(*NODE, place, (F.col("_all") + 1).cast("long").alias("rank"), (F.col("_taken") == 0).alias("asked"), *more), "places"
    )


def _with_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Facts of their nodes beside rows. Where nodes are too many to broadcast, each has a small share of the rows."""
    return rows.join(broadcast_small(nodes, MAX_BROADCAST_NODES), NODE)


def _half(side: int) -> Column:
    return F.col("node") % 2 == side


def _parent() -> Column:
    return F.shiftright("node", 1).alias("node")


def _numbered_blocks(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Blocks numbered from 0 in each list as ``node``, and the levels that the longest list takes."""
    first = blocks.groupBy("list_key").agg(F.min("block").alias("_first"), F.max("block").alias("_last"))
    most = first.agg(F.max(F.col("_last") - F.col("_first"))).first()[0] or 0
    # a row per long list
    named = blocks.join(broadcast_small(first, MAX_BROADCAST_NODES), "list_key").withColumn("node", F.col("block") - F.col("_first"))
    return durable(named.drop("_first", "_last"), "leaves"), int(most).bit_length()


def starting_lengths(summaries: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(list_key, block, n_start)`` of ``summaries`` ``(list_key, block, shift, need)``, the latter an ascending array.

    A block turns the length n into ``n + shift - (needs up to n)``.
    """
    leaves, depth = _numbered_blocks(summaries)
    nodes = [leaves.select(*NODE, "shift")]
    needs = [leaves.select(*NODE, F.posexplode("need").alias("_i", "place")).select(*NODE, "place", (F.col("_i") + 1).cast("long").alias("rank"))]
    for level in range(depth - 1):
        left = nodes[level].filter(_half(0)).select("list_key", _parent(), F.col("shift").alias("_left"))
        right = nodes[level].filter(_half(1)).select("list_key", _parent(), F.col("shift").alias("_right"))
        later = _with_nodes(needs[level].filter(_half(1)).select("list_key", _parent(), "place"), left)
        # A need that the left half's own entries meet is met from any length.
        met = later.filter("place <= _left").groupBy(*NODE).agg(F.count(F.lit(1)).alias("_met"))
        none = F.lit(0).cast("long")
        shift = F.col("_left") + F.coalesce("_right", none) - F.coalesce("_met", none)
        nodes.append(durable(left.join(right, NODE, "left").join(met, NODE, "left").select(*NODE, shift.alias("shift")), "nodes"))
        taken = needs[level].filter(_half(0)).select("list_key", _parent(), "place", "rank")
        asked = later.filter("place > _left").select(*NODE, (F.col("place") - F.col("_left")).alias("n"))
        needs.append(_free_places(taken, asked, block_rows).select(*NODE, "place", "rank"))

    starts = leaves.filter("node = 0").select(*NODE, F.lit(0).cast("long").alias("n_start"))
    for level in reversed(range(depth)):
        first = starts.select("list_key", (F.col("node") * 2).alias("node"), "n_start")
        lost = _with_nodes(needs[level].filter(_half(0)), first).filter("place <= n_start").groupBy(*NODE).agg(F.count(F.lit(1)).alias("_lost"))
        after = F.col("n_start") + F.col("shift") - F.coalesce("_lost", F.lit(0).cast("long"))
        second = first.join(nodes[level], NODE).join(lost, NODE, "left").select("list_key", (F.col("node") + 1).alias("node"), after.alias("n_start"))
        starts = durable(first.unionByName(second.join(nodes[level], NODE, "left_semi")), "starts")
    return starts.join(leaves.select(*NODE, "block"), NODE).select("list_key", "block", "n_start")


def origins(removed: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Where entries came from: ``(list_key, block, hit_pos, origin, kept_rank)``.

    ``removed`` is ``(list_key, block, positions, n_left, n_start)``: the ascending places in the starting list
    that a block removed, the entries of its own that it left, and the length it started from.
    ``origin`` is the block that left the entry, ``kept_rank`` its 0-based place among those.

    Upwards, a place is either older than the left neighbour, and asks for a free place there, or one of
    those that it left. Downwards, such a one goes left or right until it is at a leaf.
    """
    leaves, depth = _numbered_blocks(removed)
    request = ["block", "hit_pos"]
    hits = leaves.select(*NODE, "block", F.posexplode("positions").alias("_i", "place")).select(
        *NODE, "place", (F.col("_i") + 1).cast("long").alias("rank"), "block", F.col("place").alias("hit_pos")
    )
    nodes = leaves.select(*NODE, (F.col("n_start") - F.size("positions")).alias("old"), F.col("n_left").alias("own"))
    none = F.lit(0).cast("long")
    kept, found = [], []  # by level: what stays of a left half, and what its neighbour took of it
    for _ in range(depth):
        left = nodes.filter(_half(0)).select("list_key", _parent(), "old", "own")
        right = nodes.filter(_half(1)).select("list_key", _parent(), F.col("own").alias("_right"))
        later = _with_nodes(hits.filter(_half(1)).select("list_key", _parent(), "place", "rank", *request), left)
        split = later.groupBy(*NODE).agg(
            F.count(F.when(F.col("place") <= F.col("old"), 1)).alias("_past"), F.count(F.when(F.col("place") > F.col("old"), 1)).alias("_here")
        )
        both = durable(
            left.join(right, NODE, "left").join(split, NODE, "left").select(
                *NODE, "old", F.coalesce("_past", none).alias("past"), (F.col("own") - F.coalesce("_here", none)).alias("stays"),
                F.coalesce("_right", none).alias("own"),
            ),
            "nodes",
        )
        kept.append(both.select(*NODE, "stays"))
        here = _with_nodes(later.filter("place > old").drop("old", "own"), both.select(*NODE, "old", "past"))
        found.append(here.select(
            "list_key", (F.col("node") * 2).alias("node"), (F.col("place") - F.col("old")).alias("place"),
            (F.col("rank") - F.col("past")).alias("rank"), *request,
        ))
        taken = hits.filter(_half(0)).select("list_key", _parent(), "place", "rank", *request)
        hits = _free_places(taken, later.filter("place <= old").select(*NODE, F.col("place").alias("n"), *request), block_rows).drop("asked")
        nodes = both.select(*NODE, (F.col("old") - F.col("past")).alias("old"), (F.col("stays") + F.col("own")).alias("own"))

    sought = None  # (*NODE, place, *request): the place-th of what a node left
    for level in reversed(range(depth)):
        if sought is None:
            sought = found[level].drop("rank")
            continue
        at = _with_nodes(sought, kept[level])
        lower = at.filter("place <= stays").select("list_key", (F.col("node") * 2).alias("node"), F.col("place").alias("n"), *request)
        upper = at.filter("place > stays").select(
            "list_key", (F.col("node") * 2 + 1).alias("node"), (F.col("place") - F.col("stays")).alias("place"), *request
        )
        placed = _free_places(found[level], lower, block_rows).filter("asked").select(*NODE, "place", *request)
        sought = placed.unionByName(upper).unionByName(found[level].drop("rank"))
        sought = durable(sought, "sought")
    if sought is None:  # lists of one block start empty
        sought = hits.drop("rank")
    leaf = leaves.select(*NODE, F.col("block").alias("origin"))
    return sought.join(broadcast_small(leaf, MAX_BROADCAST_NODES), NODE).select("list_key", *request, "origin", (F.col("place") - 1).alias("kept_rank"))
