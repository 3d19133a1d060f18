"""SimHash near-duplicates over a Gray-order hierarchical index.

``fingerprint`` gives each text a fingerprint of 64 bits. ``links`` finds close fingerprints: the bits
are cut into blocks, and every fingerprint goes to one group for each choice of ``AGREE`` of them, so
that two fingerprints that agree on those blocks meet. With ``limit + AGREE`` blocks no pair within
the limit is missed. Keys of two blocks have about 21 bits, so that groups stay small while a
billion fingerprints are compared; beyond that, three of seven blocks give 27 bits.

Inside a group they are sorted by Gray rank, which puts similar bit patterns next to each other, and
cut into nodes. A node keeps the bits that all its members share (a mask and a pattern); pairs of
nodes are walked from the top, adding up the differences on shared bits, and a pair is dropped with
all its members once they exceed the limit.

Equal fingerprints count once. A group of more than ``GROUP_ROWS`` fingerprints is cut into
chunks that are compared two by two in tasks of their own, so a hot group never meets in one task.
A task reports a spanning forest of the links it finds, not the pairs; ``components`` joins those.

A null text counts as empty. Texts without words have fingerprint zero and are linked like any
other; very long texts are read whole, their shingles in stretches. Rows with equal ids are all
fingerprinted; rows without an id get a fingerprint, link nothing and have no component. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.order import ordered_index
from dialogprep.session import durable

SEED = 42
GROUP_ROWS = 1024
#: Blocks that make a key.
AGREE = 2
LEAF = 16
FAN = 8
#: Below this a group is compared directly.
SMALL = 64


# ---- fingerprints

def _set_bits(words: np.ndarray) -> np.ndarray:
    """How many of the words have each bit set. Sums run in bytes over 255 rows at a time."""
    bits = np.unpackbits(words.view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    total = bits[whole:].sum(axis=0, dtype=np.uint8).astype(np.int64)
    if whole:
        total += np.add.reduce(bits[:whole].reshape(-1, 255, bits.shape[1]), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def shingle_hashes(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """A hash of each shingle, in the order of the text. Fewer words than a shingle has are one."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)


def fingerprint(text: str | None, shingle: int, seed: int = SEED) -> bytes:
    """A little-endian word. A bit is set if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, shingle, seed)
    n = len(hashes)
    if not n:
        return bytes(8)
    set_bits = sum(_set_bits(hashes[i : i + 65_280]) for i in range(0, n, 65_280))
    return np.packbits(2 * set_bits > n, bitorder="little").tobytes()


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, content, fp)`` of every row; ``content`` tells the texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.binary())], ["id", "content", "fp"])

    return docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("content"), F.col(text).alias("text")).mapInArrow(
        run, "id long, content long, fp binary")


def as_hex(fp: Column) -> Column:
    """The usual hex digits of a fingerprint, highest first."""
    return F.lower(F.concat(*[F.substring(F.hex(fp), 15 - 2 * i, 2) for i in range(8)]))


# ---- the index inside one group

def _gray_order(v: np.ndarray) -> np.ndarray:
    rank = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return np.lexsort(rank.T[::-1])


def _apart(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int32)


def close_pairs(v: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of ``v`` that differ in at most ``limit`` bits."""
    n = len(v)
    if n <= SMALL:
        i, j = np.triu_indices(n, 1)
        near = _apart(v[i] ^ v[j]) <= limit
        return i[near], j[near]
    order = _gray_order(v)
    w = v[order]
    levels = []  # from the leaves up: (shared bits, their pattern)
    starts = np.arange(0, n, LEAF)
    every, some = np.bitwise_and.reduceat(w, starts), np.bitwise_or.reduceat(w, starts)
    while True:
        levels.append((~(every ^ some), every))
        if len(every) <= SMALL:
            break
        starts = np.arange(0, len(every), FAN)
        every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
    a, b = np.triu_indices(len(levels[-1][0]), 0)
    apart = np.zeros(len(a), np.int32)  # differences so far, and the bits that they were counted on
    seen = np.zeros((len(a), v.shape[1]), np.uint64)
    for depth in range(len(levels) - 1, -1, -1):
        mask, pattern = levels[depth]
        both = mask[a] & mask[b]
        apart = apart + _apart((pattern[a] ^ pattern[b]) & both & ~seen)
        live = apart <= limit
        a, b, apart, seen = a[live], b[live], apart[live], both[live]
        size, below = (FAN, len(levels[depth - 1][0])) if depth else (LEAF, n)
        if depth:
            a, b, keep = _children(a, b, size, below)
            apart, seen = apart[keep], seen[keep]
    found = [], []
    for k in range(0, len(a), 4096):  # members of the leaf pairs that are left
        x, y, _ = _children(a[k : k + 4096], b[k : k + 4096], LEAF, n)
        off = x < y
        x, y = x[off], y[off]
        near = _apart(w[x] ^ w[y]) <= limit
        found[0].append(order[x[near]])
        found[1].append(order[y[near]])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found[0]]), np.concatenate([none, *found[1]])


def _children(a: np.ndarray, b: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Child pairs ``x <= y`` of node pairs, and the parent of each."""
    step = np.arange(fan)
    x = np.repeat(a[:, None] * fan + step, fan, axis=1).reshape(len(a), -1)
    y = np.tile(b[:, None] * fan + step, (1, fan)).reshape(len(a), -1)
    parent = np.repeat(np.arange(len(a)), fan * fan).reshape(len(a), -1)
    ok = (x < n) & (y < n) & ((a != b)[:, None] | (x <= y))
    return x[ok], y[ok], parent[ok]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member linked to each of ``n`` members."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (again := root[root]).tobytes() != root.tobytes():
            root = again
        live = root[i] != root[j]
        i, j = i[live], j[live]
    return root


# ---- links over all groups

def _cuts(blocks: int, agree: int) -> list[np.ndarray]:
    """The bits of each key: every choice of ``agree`` of the ``blocks`` that 64 bits are cut into."""
    edges = [round(k * 64 / blocks) for k in range(blocks + 1)]
    return [np.concatenate([np.arange(edges[k], edges[k + 1]) for k in chosen])[:40] for chosen in combinations(range(blocks), agree)]


def _keys(fps: DataFrame, limit: int, agree: int, full: bool = True) -> DataFrame:
    """One row per key: the number of its choice of blocks, then their bits."""
    cuts = _cuts(limit + agree, agree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            keys = np.empty((len(bits), len(cuts)), np.int64)
            for k, cut in enumerate(cuts):
                keys[:, k] = bits[:, cut] @ (1 << np.arange(len(cut), dtype=np.int64)) + (k << 40)
            columns, names = [pa.array(keys.ravel())], ["key"]
            if full:
                rows = pa.array(np.repeat(np.arange(len(bits)), len(cuts)))
                columns, names = columns + [batch.column(0).take(rows), batch.column(1).take(rows)], ["key", "node", "fp"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return fps.select("node", "fp").mapInArrow(run, "key long, node long, fp binary" if full else "key long")


def _meetings(fps: DataFrame, limit: int, agree: int, group_rows: int) -> DataFrame:
    """``(key, part, node, fp)``: what is compared in one task stands together."""
    counts = _keys(fps, limit, agree, False).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = durable(counts.filter(F.col("n") > group_rows).select("key", F.ceil(F.col("n") / group_rows).cast("int").alias("c")), "hot")
    chunks = F.coalesce("c", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    pairs = _keys(fps, limit, agree).join(hot, "key", "left").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    part = F.least("own", "other") * chunks + F.greatest("own", "other")
    return pairs.select("key", part.alias("part"), "node", "fp").repartition("key", "part").sortWithinPartitions("key", "part")


def links(fps: DataFrame, limit: int, agree: int = AGREE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect what is close among ``fps(node, fp)``, whose ``fp`` are distinct."""
    grouped = _meetings(fps, limit, agree, group_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, raw in _groups(batches):
            v = np.frombuffer(raw, "<u8").reshape(-1, 1)
            i, j = close_pairs(v, limit)
            if len(i):
                by_node = np.argsort(nodes, kind="stable")
                place = np.empty(len(nodes), np.int64)
                place[by_node] = np.arange(len(nodes))
                root = _forest(len(nodes), place[i], place[j])
                tied = np.flatnonzero(root != np.arange(len(nodes)))
                ids = nodes[by_node]
                yield pa.RecordBatch.from_arrays([pa.array(ids[root[tied]]), pa.array(ids[tied])], ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Node ids and fingerprints of each run of equal ``(key, part)`` that has more than one row, or stands at an end of a batch."""
    held: list[tuple[np.ndarray, bytes]] = []
    last = None

    def whole():
        return np.concatenate([n for n, _ in held]), b"".join(r for _, r in held)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, fps = batch.column(2).to_numpy(), batch.column(3).to_pylist()
        cuts = np.concatenate(([0], np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1, [len(key)]))
        # a group of one has no pairs; only at a batch's ends may it go on
        met = np.diff(cuts) > 1
        met[[0, -1]] = True
        for s, e in zip(cuts[:-1][met].tolist(), cuts[1:][met].tolist()):
            if held and (key[s], part[s]) != last:
                yield whole()
                held = []
            held.append((nodes[s:e], b"".join(fps[s:e])))
            last = key[s], part[s]
    if held:
        yield whole()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node it reaches.

    Alternates two star steps until nothing changes; each step is written to the shared folder.
    """
    edges = durable(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = durable(both.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("m")), "least")
        large = durable(both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct(), "large")
        low = durable(large.groupBy("b").agg(F.min("a").alias("m")), "low")
        turned = large.join(low, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        edges = durable(turned.union(low.select(F.col("m").alias("a"), "b")).filter("a < b").distinct(), "edges")


def grouped(fps: DataFrame, limit: int, agree: int = AGREE) -> DataFrame:
    """Add ``component_id`` to the rows of ``fps(id, ..., fp)``: the smallest id that a row reaches."""
    fps = durable(fps, "fingerprints")
    nodes = durable(fps.groupBy("fp").agg(F.min("id").alias("node")).filter("node is not null"), "nodes")
    if nodes.groupBy("node").count().filter("count > 1").isEmpty():
        roots = components(links(nodes, limit, agree))
        named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    else:  # texts that share an id are not linked by it: places in the order of ids stand for them
        placed = durable(ordered_index(nodes.withColumnRenamed("node", "id"), ["id", "fp"], "node"), "placed")
        roots = components(links(placed, limit, agree))
        rooted = placed.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
        named = rooted.join(placed.select(F.col("node").alias("root"), F.col("id").alias("component_id")), "root").drop("root")
    out = fps.join(durable(named, "named"), "fp", "left")
    return out.select(*fps.columns, F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, limit: int = 4) -> DataFrame:
    """``(id, content, fp, component_id)`` of every row; fingerprints link at ``limit`` or fewer differing bits."""
    return grouped(fingerprints(docs, id, text, shingle), limit)


# ---- keeping one of each group

def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, limit: int = 4) -> DataFrame:
    """``docs`` with one row, that of the smallest id, for each group of near-duplicates.

    A row goes by its id and text: another text under an id is a document of its own. Of the rows that
    share the id of a document that stays, the least text stays, null first. Rows without an id stay.
    Texts without words are one group. All columns pass through, whatever their names.
    """
    found = durable(near_duplicates(docs, id, text, shingle, limit).select("id", "content", "component_id"), "components")
    gone = found.filter(F.col("component_id") < F.col("id")).select("id", "content").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    left = rows.join(durable(gone, "gone"), ["id", "content"], "left_anti")
    twice = durable(found.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "twice")
    if twice.isEmpty():
        return left.select("row.*")
    # one row per id by a partial aggregation, however often an id stands
    one = left.join(twice, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row"))
    return left.join(twice, "id", "left_anti").select("row.*").unionByName(one.select("row.*"))
