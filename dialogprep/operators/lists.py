"""Replay of "append" and "remove the n-th" operations on many ordered lists at once.

The log is numbered list by list (``seq``) and cut into blocks of ``block_rows`` consecutive
operations. Every block is one task-sized group whatever the lists look like: it holds many
small lists, or a stretch of a large one. A list that crosses a block boundary needs two facts
from its earlier blocks: how long it is when the block begins, and which earlier entry is the
p-th one then. Both come from one summary row per block:

* Removing the n-th entry succeeds from a smallest starting length on. The set of those
  lengths turns any starting length into the length at the end of the block.
* With starting lengths known, each block resolves its removals to its own entries or to
  positions in the starting list. Walking the summaries in order maps positions to entries.

The summaries of one list are walked in one group as long as they hold ``group_rows`` numbers at
most. Those of longer lists are combined as a tree of written levels (``operators/trees.py``).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from dialogprep.operators.trees import origins, starting_lengths
from dialogprep.session import broadcast_small, durable

LIST_BLOCK_ROWS = 16_384
LIST_GROUP_ROWS = 1 << 20
MAX_BROADCAST_ROWS = 65_536


def _nth_free(taken: list[int], n: int) -> int:
    """The n-th positive integer that is not in the sorted list ``taken``."""
    low, high = 0, len(taken)
    while low < high:
        mid = (low + high) // 2
        if taken[mid] - mid - 1 < n:
            low = mid + 1
        else:
            high = mid
    return n + low


def _stretches(pdf: pd.DataFrame) -> Iterator[tuple[str, dict[str, list]]]:
    """The lists of one block, each in log order, with their columns as plain lists.

    A block can hold thousands of small lists, so a list costs slices and no data frame.
    """
    order = np.argsort(pdf["seq"].to_numpy(), kind="stable")
    keys = pdf["list_key"].to_numpy()[order]
    columns = {c: pdf[c].to_numpy()[order].tolist() for c in ("seq", "op", "index", "n_start") if c in pdf.columns}
    edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:]):
        yield keys[a], {c: values[a:b] for c, values in columns.items()}


def _summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Per list: what the block does to the length of the list it starts from."""
    out = []
    for list_key, part in _stretches(pdf):
        shift, need = 0, []
        for op, index in zip(part["op"], part["index"]):
            if op == "add":
                shift += 1
            elif op == "remove" and index >= 1:
                if index <= shift:
                    shift -= 1  # succeeds even from an empty list
                else:
                    insort(need, _nth_free(need, index - shift))
        out.append((list_key, key[0], shift, need))
    return pd.DataFrame(out, columns=["list_key", "block", "shift", "need"])


def _starting_lengths(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("block", kind="stable")
    n, lengths = 0, []
    for shift, need in zip(pdf["shift"].tolist(), pdf["need"]):
        lengths.append(n)
        n = n + shift - int(np.searchsorted(np.asarray(need, dtype=np.int64), n, side="right"))
    return pdf[["list_key", "block"]].assign(n_start=np.asarray(lengths, dtype=np.int64))


def _outcomes(edges: list[int], adds: list[bool], removes: list[bool], index: list[int], n_start: list[int]) -> dict[str, np.ndarray]:
    """Outcome of each operation of a block by its row; list ``k`` has the rows ``edges[k] .. edges[k + 1] - 1``.

    ``hit`` is the row whose entry a removal takes, ``old`` the place in the starting list instead,
    ``rank`` the place of an entry among those that its list keeps of the block.
    """
    n = edges[-1]
    ok, hit, old, size, rank = [True] * n, [-1] * n, [-1] * n, [0] * n, [-1] * n
    for a, b, left in zip(edges, edges[1:], n_start):
        gone, own = [], []
        for row in range(a, b):
            if adds[row]:
                own.append(row)
            elif removes[row]:
                place = index[row]
                if not 1 <= place <= left + len(own):
                    ok[row] = False
                elif place <= left:
                    old[row] = _nth_free(gone, place)
                    insort(gone, old[row])
                    left -= 1
                else:
                    hit[row] = own.pop(place - left - 1)
            size[row] = left + len(own)
        for place, row in enumerate(own):
            rank[row] = place
    long = {"hit": hit, "old": old, "n_after": size, "kept_rank": rank}
    return {"ok": np.array(ok, dtype=bool), **{c: np.array(values, dtype=np.int64) for c, values in long.items()}}


def _resolve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Outcome of each operation of a block, given the starting lengths."""
    pdf = pdf.sort_values("seq", kind="stable")
    keys, seq, op = pdf["list_key"].to_numpy(), pdf["seq"].to_numpy(), pdf["op"].to_numpy()
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    starts = np.flatnonzero(first)
    done = _outcomes(
        [*starts.tolist(), len(keys)], (op == "add").tolist(), (op == "remove").tolist(), pdf["index"].tolist(), pdf["n_start"].to_numpy()[starts].tolist()
    )
    return pd.DataFrame({
        "list_key": keys, "block": key[0], "seq": seq, "ok": done["ok"], "hit_seq": np.where(done["hit"] < 0, -1, seq[done["hit"]]),
        "hit_pos": done["old"], "n_after": done["n_after"], "kept_rank": done["kept_rank"],
    })


def _locate(pdf: pd.DataFrame) -> pd.DataFrame:
    """Map positions in starting lists to (block of origin, rank among that block's leftovers).

    The live list is a sequence of runs of leftovers, so its size here follows the number of
    gaps, not the number of entries.
    """
    pdf = pdf.sort_values("block", kind="stable")
    origin, low, count = (np.empty(0, dtype=np.int64) for _ in range(3))
    found = []
    for block, positions, n_left in zip(pdf["block"].tolist(), pdf["positions"], pdf["n_left"].tolist()):
        hit = np.asarray(positions, dtype=np.int64) - 1
        if len(hit):
            end = np.cumsum(count)
            start = end - count
            run = np.searchsorted(end, hit, side="right")
            found.append(pd.DataFrame({
                "block": block, "hit_pos": hit + 1, "origin": origin[run], "kept_rank": low[run] + hit - start[run],
            }))
            cuts = np.unique(np.concatenate([start, hit + 1]))
            cuts = cuts[cuts < end[-1]]
            stops = np.append(cuts[1:], end[-1])
            size = stops - cuts - np.isin(stops - 1, hit)
            run = np.searchsorted(end, cuts, side="right")
            keep = size > 0
            origin, low, count = origin[run][keep], (low[run] + cuts - start[run])[keep], size[keep]
        if n_left:
            origin, low, count = np.append(origin, block), np.append(low, 0), np.append(count, n_left)
    out = pd.concat(found) if found else pd.DataFrame({"block": [], "hit_pos": [], "origin": [], "kept_rank": []}, dtype="int64")
    out.insert(0, "list_key", pdf["list_key"].iloc[0])
    return out


def _by_size(summaries: DataFrame, numbers: str, group_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Summaries of lists whose arrays ``numbers`` fit one group, and those of the longer lists if there are any."""
    size = F.sum(F.size(numbers) + 1)
    long = durable(summaries.groupBy("list_key").agg(size.alias("_n")).filter(F.col("_n") > group_rows).select("list_key"), "long-lists")
    if long.isEmpty():
        return summaries, None
    named = broadcast_small(long, group_rows)
    return summaries.join(named, "list_key", "left_anti"), summaries.join(named, "list_key", "left_semi")


def _at(rows: np.ndarray) -> pa.Array:
    """Row numbers to take, null where they are below 0."""
    return pa.array(np.maximum(rows, 0), mask=rows < 0)


def _settle(block: int, ops: pa.Table, notes: pa.Table, more: list[str], of_target: list[str], of_removal: list[str]) -> pa.Table:
    """The operations of a block in log order, next to their outcomes, their notes and the other end of their removals.

    ``kept_rank`` is only given for the first and the last list, which may go on in another block.
    """
    ops = ops.combine_chunks().sort_by("seq")
    seq = ops["seq"].to_numpy()
    for c in more:
        known = notes.filter(pc.is_valid(notes[c])).combine_chunks()
        rows = np.full(len(seq), -1)
        rows[np.searchsorted(seq, known["seq"].to_numpy())] = np.arange(len(known))
        ops = ops.append_column(c, known[c].take(_at(rows)) if len(known) else pa.nulls(len(seq), known[c].type))
    listed = np.flatnonzero(ops["list_key"].is_valid().to_numpy())
    n_after, kept_rank, hit_pos, hit, gone = (np.full(len(seq), -1) for _ in range(5))
    ok, on_list = np.zeros(len(seq), bool), np.zeros(len(seq), bool)
    on_list[listed] = True
    if len(listed):
        keys = ops["list_key"].take(pa.array(listed)).combine_chunks()
        first = np.concatenate(([True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)))
        starts = notes.filter(pc.is_valid(notes["n_start"]))
        starts = dict(zip(starts["list_key"].to_pylist(), starts["n_start"].to_pylist()))
        lengths = np.array([starts.get(k, 0) for k in keys.filter(pa.array(first)).to_pylist()]) if starts else np.zeros(first.sum(), np.int64)
        number = np.cumsum(first) - 1
        part = ops.select(["seq", "op", "index"]).take(pa.array(listed))
        index = pc.fill_null(part["index"], 0).to_numpy()
        done = _resolve((block,), pd.DataFrame({
            "list_key": number, "seq": part["seq"].to_numpy(), "op": part["op"].to_numpy(), "index": index, "n_start": lengths[number],
        }))
        ok[listed], n_after[listed], hit_pos[listed] = (done[c].to_numpy() for c in ("ok", "n_after", "hit_pos"))
        at_end = (number == 0) | (number == number[-1])  # no other list goes on in another block
        kept_rank[listed[at_end]] = done["kept_rank"].to_numpy()[at_end]
        target = done["hit_seq"].to_numpy(dtype=np.int64)
        removing = listed[target >= 0]
        hit[removing] = np.searchsorted(seq, target[target >= 0])
        gone[hit[removing]] = removing
    out = {
        "ok": pa.array(ok, mask=~on_list), "hit_pos": pa.array(hit_pos), "n_after": pa.array(n_after, mask=~on_list), "kept_rank": pa.array(kept_rank),
        "target_seq": ops["seq"].take(_at(hit)), **{f"target_{c}": ops[c].take(_at(hit)) for c in of_target},
        "gone_seq": ops["seq"].take(_at(gone)), **{f"gone_{c}": ops[c].take(_at(gone)) for c in of_removal},
    }
    for c, values in out.items():
        ops = ops.append_column(c, values)
    return ops


def replay_rows(
    ops: DataFrame, notes: DataFrame | None = None, of_target: Sequence[str] = (), of_removal: Sequence[str] = (),
    block_rows: int = LIST_BLOCK_ROWS, group_rows: int = LIST_GROUP_ROWS,
) -> DataFrame:
    """Operations next to ``(ok, target_seq, n_after, gone_seq)``, their notes and the other end of their removals.

    ``ops`` is ``(list_key, seq, op, index, ...)`` with ``seq`` dense and grouped by list, ``op``
    one of add, remove, look, and ``index`` the 1-based place for a removal. Rows without a
    ``list_key`` pass through. ``target_seq`` is the add operation whose entry was removed,
    ``n_after`` the length afterwards; an entry that was removed has the ``seq`` of the removal as
    ``gone_seq``. ``notes`` is ``(seq, ...)``; each of its columns has at most one value for a
    ``seq``, and is added. ``of_target`` names columns of a removed entry that are put beside its
    removal as ``target_*``, ``of_removal`` those of a removal beside its entry as ``gone_*``.

    Whole rows are shuffled once, to their block. What a removal and its entry tell each other
    stays there, but for lists that cross a block. No group is given more than ``block_rows``
    operations, with their notes, or ``group_rows`` numbers of summaries.
    """
    spark, of_target, of_removal = ops.sparkSession, list(of_target), list(of_removal)
    block = F.expr(f"seq div {block_rows}").alias("block")
    if notes is None:
        notes = spark.createDataFrame([], "seq long")
    more = [c for c in notes.columns if c != "seq"]
    # Stretches of lists that cross a block boundary, at most two a block. A list is contiguous,
    # so each block it reaches into touches one of its boundaries.
    at_edge = F.expr(f"seq % {block_rows} in (0, {block_rows - 1}) and list_key is not null")
    crossing = durable(
        ops.filter(at_edge)
        .groupBy(F.expr(f"(seq + 1) div {block_rows}").alias("edge"), "list_key")
        .agg(F.count_distinct(block).alias("sides"))
        .filter("sides > 1")
        .select("list_key", F.explode(F.array(F.col("edge") - 1, F.col("edge"))).alias("block"))
        .distinct(),
        "crossing",
    )
    stretch = ["list_key", "block"]
    summaries = durable(
        ops.select("list_key", "seq", "op", F.coalesce("index", F.lit(0)).cast("long").alias("index"), block).join(broadcast_small(crossing, MAX_BROADCAST_ROWS), stretch, "left_semi")
        .groupBy("block").applyInPandas(_summarise, "list_key string, block long, shift long, need array<long>"),
        "summaries",
    )
    short, long = _by_size(summaries, "need", group_rows)
    starts = short.groupBy("list_key").applyInPandas(_starting_lengths, "list_key string, block long, n_start long")
    if long is not None:
        starts = starts.unionByName(starting_lengths(long))
    starts = durable(starts, "starts")
    beside = notes.withColumn("block", block).unionByName(starts, allowMissingColumns=True)

    def settle(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _settle(key[0].as_py(), left, right, more, of_target, of_removal)

    types = {f.name: f.dataType for f in [*ops.schema.fields, *notes.schema.fields]}
    schema = StructType([StructField(c, t) for c, t in {
        **{c: types[c] for c in ops.columns}, "block": LongType(), **{c: types[c] for c in more},
        "ok": BooleanType(), "hit_pos": LongType(), "n_after": LongType(), "kept_rank": LongType(),
        "target_seq": LongType(), **{f"target_{c}": types[c] for c in of_target},
        "gone_seq": LongType(), **{f"gone_{c}": types[c] for c in of_removal},
    }.items()])
    resolved = durable(ops.withColumn("block", block).groupBy("block").cogroup(beside.groupBy("block")).applyInArrow(settle, schema), "resolved")
    plain = resolved.drop("block", "hit_pos", "kept_rank")

    # What lists that cross a block removed of earlier blocks.
    shared = durable(
        resolved.filter("hit_pos > 0 or kept_rank >= 0")
        .select(*stretch, "hit_pos", "kept_rank", "seq", *dict.fromkeys([*of_target, *of_removal]))
        .join(broadcast_small(crossing, MAX_BROADCAST_ROWS), stretch, "left_semi"),
        "shared",
    )
    removed = durable(
        shared.groupBy(*stretch).agg(
            F.array_sort(F.collect_list(F.when(F.col("hit_pos") > 0, F.col("hit_pos")))).alias("positions"),
            F.count(F.when(F.col("kept_rank") >= 0, 1)).alias("n_left"),
        ),
        "removed",
    )
    short, long = _by_size(removed, "positions", group_rows)
    located = short.groupBy("list_key").applyInPandas(
        _locate, "list_key string, block long, hit_pos long, origin long, kept_rank long"
    )
    if long is not None:
        located = located.unionByName(origins(long.join(starts, stretch)))
    leftovers = shared.filter("kept_rank >= 0").select(
        "list_key", F.col("block").alias("origin"), "kept_rank", F.col("seq").alias("old_seq"), *[F.col(c).alias(f"target_{c}") for c in of_target]
    )
    removals = shared.filter("hit_pos > 0").select(*stretch, "hit_pos", "seq", *[F.col(c).alias(f"gone_{c}") for c in of_removal])
    pairs = located.join(leftovers, ["list_key", "origin", "kept_rank"]).join(removals, [*stretch, "hit_pos"])
    pairs = durable(pairs.select("seq", "old_seq", *[f"target_{c}" for c in of_target], *[f"gone_{c}" for c in of_removal]), "pairs")
    ends = pairs.select("seq", F.col("old_seq").alias("target_seq"), *[f"target_{c}" for c in of_target]).unionByName(
        pairs.select(F.col("old_seq").alias("seq"), F.col("seq").alias("gone_seq"), *[f"gone_{c}" for c in of_removal]), allowMissingColumns=True
    )
    far = [c for c in ends.columns if c != "seq"]
    ends = ends.withColumnsRenamed({c: f"_far_{c}" for c in far})
    few = ends.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    both = plain.join(F.broadcast(ends) if few else ends, "seq", "left")
    both = both.withColumns({c: F.coalesce(c, f"_far_{c}") for c in far}).select(*plain.columns)
    return both if few else durable(both, "rows")  # so that whole rows are joined once


def replay_lists(ops: DataFrame, block_rows: int = LIST_BLOCK_ROWS, group_rows: int = LIST_GROUP_ROWS) -> DataFrame:
    """Outcome of each operation ``(list_key, seq, op, index)``: ``(seq, ok, target_seq, n_after)``."""
    return replay_rows(ops, block_rows=block_rows, group_rows=group_rows).select("seq", "ok", "target_seq", "n_after")
