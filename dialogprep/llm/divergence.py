"""Divergence between the sources of a language, over run-length columns of term counts.

Terms are counted inside tasks and summed per (language, source, term). A language keeps the terms
that stand in enough of its documents. Its vocabulary is put in one order in which equal counts lie
together: by the counts in its largest sources, then by the total, then by a check sum of all counts.
A group (language, source) is then a column with long runs of equal counts, most of them zeros. For a
pair of sources the boundaries of both columns' runs are intersected, and the difference of each
stretch is multiplied by its length.

The vocabulary is cut into blocks of ``BLOCK_TERMS`` and the sources of a language into chunks of
``CHUNK``; a task compares two chunks over one block, so neither a large vocabulary nor many sources
meet in one place. The pairs of a language's sources are the result itself.

All arithmetic is exact: shares are whole numbers of parts in a thousand million, from decimals of 38
digits. Null texts, languages and sources count as empty ones. Texts of any length are read whole; one
document's words are held at a time. Repeated rows are documents of their own. Equal values are
ranked by the item's UTF-8 bytes. A group without terms still has a share for every term; a language
without kept terms gives its pairs of sources the value 0. An empty table gives no rows. Columns
beyond the three are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.operators.order import ordered_index
from dialogprep.session import broadcast_small, durable

LEAST_DOCS = 10
PARTS = 1_000_000_000
TOP = 10
BLOCK_TERMS = 16_384
CHUNK = 32
#: Sources whose counts lead the order of the vocabulary.
LEADING = 8
#: Entries that a task holds before it passes them on.
HELD_ENTRIES = 500_000
MAX_BROADCAST_GROUPS = 100_000

#: Bytes of terms: letters, and all of what is beyond ASCII; capitals go down, the rest parts terms.
_TERMS = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERMS).split()


# ---- counts

def _counted(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents that have the term; several rows for one term."""

    def passed(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, having) in held.items():
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(total), pa.string()), pa.array([source] * len(total), pa.string()), pa.array(list(total), pa.binary()).cast(pa.string()),
                     pa.array(list(total.values()), pa.int64()), pa.array([having[t] for t in total], pa.int64())], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                total, having = held.setdefault((lang, source), (Counter(), Counter()))
                words = terms_of(text.as_py())
                total.update(words)
                having.update(set(words))
            if sum(len(t) for t, _ in held.values()) > HELD_ENTRIES:
                yield from passed(held)
                held = {}
        yield from passed(held)

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(n: Column, of: Column, terms: Column) -> Column:
    """``1 + floor(PARTS * (n + 2) / (of + 2 * terms))``."""
    over = (n.cast("decimal(20,0)") + F.lit(2)) * F.lit(PARTS)
    under = of.cast("decimal(20,0)") + F.lit(2) * terms.cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, under)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


# ---- run-length columns

def runs_of(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts, and its value."""
    starts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1)) if len(column) else np.empty(0, np.int64)
    return starts, column[starts]


def runs_apart(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """The gaps of two columns summed over their stretches of ``size`` values."""
    cuts = np.union1d(one[0], two[0])
    if not len(cuts):
        return 0
    p = one[1][np.searchsorted(one[0], cuts, side="right") - 1]
    q = two[1][np.searchsorted(two[0], cuts, side="right") - 1]
    return int(((p - q) * (p - q) // (p + q) * np.diff(cuts, append=size)).sum())


def _block_pairs(kept: DataFrame, groups: DataFrame, langs: DataFrame, block_terms: int, chunk: int) -> DataFrame:
    """``(lang, a, b, value)`` of every block and pair of groups ``a < b``, from ``kept(lang, idx, at, p)``."""
    blocks = langs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(terms - 1) div {block_terms}")))))
    size = F.least(F.lit(block_terms).cast("long"), F.col("terms") - F.col("block") * block_terms)
    # each column of each block starts with the share of a term that its group doesn't have
    heads = groups.join(blocks.select("lang", "block", size.alias("size")), "lang").select(
        "lang", "chunks", "block", "idx", F.lit(-1).cast("long").alias("at"), F.coalesce("p0", F.lit(1)).cast("long").alias("p"), F.col("size").cast("long").alias("size"))
    rows = kept.select("lang", "chunks", F.expr(f"at div {block_terms}").alias("block"), "idx", F.expr(f"at % {block_terms}").alias("at"), "p", F.lit(0).cast("long").alias("size"))
    own = F.expr(f"idx div {chunk}")
    dealt = heads.unionByName(rows).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "idx", "at", "p", "size")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        lang, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        idx, at, p, size = (table.column(c).to_numpy() for c in ("idx", "at", "p", "size"))
        n = int(size.max())
        order = np.lexsort((at, idx))
        idx, at, p = idx[order], at[order], p[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(idx)) + 1, [len(idx)]))
        columns = {}
        for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
            column = np.full(n, p[s], np.int64)
            column[at[s + 1 : e]] = p[s + 1 : e]
            columns[int(idx[s])] = runs_of(column)
        a_side = [k for k in columns if k // chunk == i]
        b_side = a_side if i == j else [k for k in columns if k // chunk == j]
        found = [(a, b, runs_apart(columns[a], columns[b], n)) for a in a_side for b in b_side if a < b]
        a, b, value = zip(*found) if found else ((), (), ())
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64())})

    return dealt.groupBy("lang", "block", "i", "j").applyInArrow(compare, "lang string, a long, b long, value long")


# ---- the audit

def audited(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP,
    block_terms: int = BLOCK_TERMS, chunk: int = CHUNK,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: each source against the others, and its terms above the language's share."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = _counted(plain).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = durable(counted, "counts")
    # every group there is, numbered in its language from the largest on
    sizes = counted.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    named = plain.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").fillna(0, ["words"])
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.col("words").desc(), "source")) - 1
    chunks = F.expr(f"(count(*) over (partition by lang) - 1) div {chunk} + 1")
    named = durable(named.select("lang", "source", place.cast("long").alias("idx"), chunks.alias("chunks")), "groups")
    few = broadcast_small(named, MAX_BROADCAST_GROUPS)
    keyed = counted.join(few, ["lang", "source"])
    leading = [F.coalesce(F.sum(F.when(F.col("idx") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(LEADING)]
    terms = keyed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), *leading, F.bit_xor(F.xxhash64("idx", "n")).alias("sum"))
    terms = durable(terms.filter(F.col("docs") >= least_docs).drop("docs"), "terms")
    placed = durable(ordered_index(terms, ["lang", *[f"c{k}" for k in range(LEADING)], "total", "sum", "term"], "place").select("lang", "term", "total", "place"), "vocabulary")
    langs = named.select("lang").distinct().join(
        placed.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.min("place").alias("first"), F.sum("total").alias("lang_words")), "lang", "left")
    langs = durable(langs.fillna(0), "languages")
    kept = durable(keyed.select("lang", "source", "idx", "chunks", "term", "n").join(placed, ["lang", "term"]), "kept")
    words = kept.groupBy("lang", "idx").agg(F.sum("n").alias("words"))
    groups = named.join(words, ["lang", "idx"], "left").fillna(0, ["words"]).join(langs, "lang")
    groups = groups.withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(0), F.col("words"), F.col("terms"))))
    groups = durable(groups, "facts")
    facts = broadcast_small(groups.select("lang", "idx", "words", "terms", "first", "lang_words"), MAX_BROADCAST_GROUPS)
    shares = kept.join(facts, ["lang", "idx"]).select(
        "lang", "source", "idx", "chunks", "term", (F.col("place") - F.col("first")).alias("at"), share(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_words"), F.col("terms")).alias("q"))
    # pairs of sources
    blocks = _block_pairs(shares, groups.select("lang", "idx", "chunks", "p0"), langs.select("lang", "terms"), block_terms, chunk)
    pairs = blocks.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    pairs = pairs.select("lang", both.alias("s"), "value").select("lang", "s.x", "s.y", "value")
    one, two = (few.select("lang", F.col("source").alias(name), F.col("idx").alias(key)) for name, key in (("source", "x"), ("item", "y")))
    pairs = pairs.join(one, ["lang", "x"]).join(two, ["lang", "y"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    # terms of a source
    above = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).cast("int").alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pairs.select(*columns, rank).unionByName(above.select(*columns, rank).filter(F.col("rank") <= top))
