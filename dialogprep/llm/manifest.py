"""Merkle manifest of a table, with proofs from checkpointed levels.

Rows become leaves. Per tree (here a language) the leaves stand in the order of their ids, and every
``FAN`` consecutive nodes become one node until a single one is left; the roots of all trees are the
leaves of one more tree. Only every ``STRIDE``-th level is written. A proof needs the siblings on
all levels; those in between are computed again from the aligned subtree of ``FAN ** STRIDE``
written nodes below them, give out their siblings and are dropped.

Paths go down from the root: a written node hands its own path to the nodes of its subtree, which put
their siblings in front. Only written nodes' paths become tables. A row's proof is hashed in the task
that holds its subtree, so a task holds one subtree at a time however large a tree is.

A null value counts as ``-`` in a leaf, so an empty text differs from a null one; texts of any length
are hashed whole by the JVM. Null trees come first. Null ids lead their tree; equal ids stand in the
order of their leaves, and repeated rows have equal leaves, so which of them comes first changes
nothing. A row without an id is never tampered with. An empty table has no leaves and no root and
gives no rows. Columns beyond the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.order import ordered_index
from dialogprep.session import broadcast_small, durable

FAN = 8
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Upper letters go down where a row is tampered with, and no other characters change.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST_TREES = 100_000


# ---- one subtree

def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def climb(nodes: list[str], count: int, stride: int, fan: int = FAN) -> list[list[str]]:
    """The levels above ``nodes``, an aligned stretch of a level of ``count`` nodes; none above a root."""
    levels = [nodes]
    while len(levels) <= stride and count > 1:
        below = levels[-1]
        levels.append([digest("".join(below[k : k + fan])) for k in range(0, len(below), fan)])
        count = -(-count // fan)
    return levels


def steps_of(levels: list[list[str]], k: int, fan: int = FAN) -> list[tuple[str, str]]:
    """Siblings (left, right) of node ``k`` on each level below the last one."""
    out = []
    for level in levels[:-1]:
        first = k - k % fan
        out.append(("".join(level[first:k]), "".join(level[k + 1 : first + fan])))
        k //= fan
    return out


def fold(leaf: str, steps: Sequence[tuple[str, str]]) -> str:
    for left, right in steps:
        leaf = digest(left + leaf + right)
    return leaf


# ---- levels

def leaf_of(values: Sequence[Column]) -> Column:
    """``-`` for null, else the bytes' number, a colon and the value; all of it hashed."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def numbered(leaves: DataFrame, tree: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves ``(tree, n, pos, ...)`` with the tree's number, size and own place, and ``(tree_name, tree, first, n)`` of all trees."""
    placed = durable(ordered_index(leaves, [tree, *order], "_place"), "leaves")
    trees = placed.groupBy(F.col(tree).alias("tree_name")).agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = durable(ordered_index(trees, ["tree_name"], "tree"), "trees")
    found = placed.join(broadcast_small(trees, MAX_BROADCAST_TREES), F.col(tree).eqNullSafe(F.col("tree_name")))
    return found.withColumn("pos", F.col("_place") - F.col("first")).drop("_place", "tree_name", "first"), trees


def _subtrees(nodes: DataFrame, size: int, *payload: str) -> DataFrame:
    """``(tree, parent, n, nodes)``: at most ``size`` consecutive nodes each, in order."""
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", *payload)))
    return nodes.groupBy("tree", F.expr(f"pos div {size}").alias("parent")).agg(F.first("n").alias("n"), members.alias("nodes"))


def written_levels(nodes: DataFrame, most: int, stride: int = STRIDE, fan: int = FAN) -> list[DataFrame]:
    """Every ``stride``-th level above ``nodes(tree, n, pos, digest)``, from ``nodes`` to the one with the roots alone.

    ``most`` is the size of the largest tree. The root of a smaller one is carried up unchanged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, parent, n, members = (c.to_pylist() for c in batch.columns)
            tops = [climb([m["digest"] for m in ms], count, stride, fan)[-1][0] for count, ms in zip(n, members)]
            left = [-(-count // fan**stride) for count in n]
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), pa.array(left, pa.int64()), pa.array(parent, pa.int64()), pa.array(tops, pa.string())],
                                             ["tree", "n", "pos", "digest"])

    out = [nodes.select("tree", "n", "pos", "digest")]
    while most > 1:
        out.append(durable(_subtrees(out[-1], fan**stride).mapInArrow(run, "tree long, n long, pos long, digest string"), "level"))
        most = -(-most // fan**stride)
    return out


# ---- proofs

_STEPS = "array<struct<left:string,right:string>>"
_PATH = f"tree long, pos long, subroot string, root string, steps {_STEPS}"
_ARROW_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _as_steps(steps: Sequence[tuple[str, str]]) -> list[dict]:
    return [{"left": a, "right": b} for a, b in steps]


def _with_paths(nodes: DataFrame, above: DataFrame, size: int, *payload: str) -> DataFrame:
    """Subtrees next to the path of the node above them."""
    paths = above.withColumnRenamed("pos", "parent")
    return _subtrees(nodes, size, *payload).join(paths, ["tree", "parent"]).select("n", "nodes", "tree", "subroot", "root", "steps")


def paths_down(levels: list[DataFrame], tops: DataFrame, stride: int = STRIDE, fan: int = FAN) -> DataFrame:
    """Paths of the nodes of ``levels[1]``, from those of the roots, ``tops(tree, pos, subroot, root, steps)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, nodes, tree, subroot, root, above in zip(*(c.to_pylist() for c in batch.columns)):
                levels = climb([m["digest"] for m in nodes], n, stride, fan)
                own = [_as_steps(steps_of(levels, k, fan)) + above for k in range(len(nodes))]
                size = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * size, pa.int64()), pa.array([m["pos"] for m in nodes], pa.int64()), pa.array([subroot] * size, pa.string()),
                     pa.array([root] * size, pa.string()), pa.array(own, _ARROW_STEPS)], ["tree", "pos", "subroot", "root", "steps"])

    for level in reversed(levels[1:-1]):
        tops = durable(_with_paths(level, tops, fan**stride).mapInArrow(run, _PATH), "paths")
    return tops


def proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, stride: int = STRIDE, fan: int = FAN) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root)`` for ``leaves(tree, n, pos, id, digest, claimed)``.

    The proof is all siblings, from the leaf to the root; ``claimed`` is what is folded with them.
    """
    above = paths_down(levels, tops, stride, fan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, nodes, _, subroot, root, above in zip(*(c.to_pylist() for c in batch.columns)):
                levels = climb([m["digest"] for m in nodes], n, stride, fan)
                up = [(s["left"], s["right"]) for s in above]
                shown, folded = [], []
                shared = "".join(a + b for a, b in up)
                for k, m in enumerate(nodes):
                    own = steps_of(levels, k, fan)
                    shown.append(digest("".join(a + b for a, b in own) + shared))
                    folded.append(fold(m["claimed"], own + up))
                size = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m["id"] for m in nodes], pa.int64()), pa.array([m["digest"] for m in nodes], pa.string()), pa.array([subroot] * size, pa.string()),
                     pa.array([root] * size, pa.string()), pa.array(shown, pa.string()), pa.array(folded, pa.string())],
                    ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    # a table of single leaves has no level above them: their paths are those of the roots
    size = fan**stride if len(levels) > 1 else 1
    return _with_paths(leaves, above, size, "id", "claimed").mapInArrow(
        run, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def manifest(
    docs: DataFrame, id: str = "doc_id", tree: str = "lang", fields: Sequence[str] = FIELDS, claimed: Sequence[Column] | None = None,
    stride: int = STRIDE, fan: int = FAN,
) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root)`` of every row.

    ``claimed`` are the values that a row is said to have, in the order of ``fields``; they are folded with
    the proof of the row as it is, and give its root only if they are the same.
    """
    leaf = leaf_of([F.col(f) for f in fields])
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(tree).cast("string").alias("name"), leaf.alias("digest"), (leaf if claimed is None else leaf_of(claimed)).alias("claimed"))
    leaves, trees = numbered(durable(rows, "hashed"), "name", ["id", "digest", "claimed"])
    most, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    levels = written_levels(leaves, most or 0, stride, fan)
    roots = durable(levels[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("pos"), "digest"), "roots")
    upper = written_levels(roots, n_trees, stride, fan)
    none = F.expr("array()").cast(_STEPS)
    whole = upper[-1].select("tree", "pos", F.col("digest").alias("subroot"), F.col("digest").alias("root"), none.alias("steps"))
    # the paths of the trees' roots, then those below them
    down = paths_down([roots, *upper], whole, stride, fan) if len(upper) > 1 else whole
    tops = down.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "root", "steps")
    tops = durable(tops.join(roots.select(F.col("pos").alias("tree"), F.col("digest").alias("subroot")), "tree").select("tree", "pos", "subroot", "root", "steps"), "tops")
    return proofs(leaves, levels, tops, stride, fan)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def every_third(id: Column) -> Column:
    """Where three divides the check sum of the decimal id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 0, F.lit(False))
