"""Removal of long repeated strings with suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else, in the same
document or another. Four steps find those strings without comparing everything with everything.

1. In every stretch of ``length`` bytes the smallest rolling hash of ``GRAM`` bytes is its anchor. The
   anchor depends on those bytes alone, so equal stretches have equal anchors, at the same place.
2. Anchors that occur once over all documents can't be part of a repeat. Around each other anchor
   the bytes of all stretches that chose it are cut out as a piece; equal pieces are kept once and counted.
3. Pieces that share an anchor form shards. Each shard gets a suffix array by Larsson-Sadakane
   refinement and common prefixes by Kasai's rule; runs of suffixes that share ``length`` bytes are
   repeats. The pieces of a frequent anchor are dealt to several shards, merged two by
   two: suffixes that are single in their own shard are looked up in the other by binary search.
4. The ranges found go back to the owners of each piece and are joined per document.

A text that occurs more than once as a whole is removed without any of this, and takes part once.
What meets in one task is a document's own anchors, or a shard of ``SHARD_BYTES``.

Passages of ``PASSAGE`` words or more that also stand in another document are counted beside this, whatever
their bytes; nothing is removed for them. Their anchors are the smallest hashes of ``WORD_GRAM`` words, so
equal stretches of words again have equal anchors. A stretch whose piece differs from the others of its anchor
is told by a hash of 64 bits among those of the same anchor. White space between words doesn't matter.

Null text counts as empty. Texts below ``length`` bytes lose nothing. Repeated rows are copies of
each other. Rows are known by their text, so ids may repeat or be null. Very long texts are read whole,
one at a time. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.session import durable

LENGTH = 400
GRAM = 160
SHARD_BYTES = 256 << 10
#: Sorting costs seconds for each MB, so tasks are cut by these bytes of pieces, not by what a shuffle writes.
TASK_BYTES = 1 << 20
MAX_TASKS = 32_768
PASSAGE = 50
WORD_GRAM = 12
_B = 0x5851F42D4C957F2D
#: The least number of one byte, of two, and so on.
_BYTES = np.array([1 << 8 * k for k in range(8)], np.uint64)


# ---- anchors

@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2**64; ``n`` is a power of two."""
    out = []
    for base in (_B, pow(_B, -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return tuple(out)


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a polynomial hash up to each place, and the powers that move a difference of two to place 0."""
    n = len(values)
    power, inverse = _powers(1 << max(12, int(n + 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * inverse[:n], out=sums[1:])
    return sums, power


def _byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(data.astype(np.uint64) + np.uint64(1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int = GRAM, sums: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A mixed polynomial hash of every ``gram`` bytes."""
    sums, power = sums or _byte_sums(data)
    return _mixed((sums[gram:] - sums[:-gram]) * power[gram - 1 : len(data)])


def _lowest(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, smallest hash) of each run of stretches of ``w`` hashes that share their smallest, leftmost on ties."""
    low = np.uint64(0xFFFFFFFF)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(v) // w) * w, np.uint64(2**64 - 1))
    padded[: len(v)] = v
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(h) - w + 1
    at = (np.minimum(behind[:starts], ahead[w - 1 : w - 1 + starts]) & low).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.append(first[1:] - 1, starts - 1)
    return first, last, h[at[first]]


def _no_runs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.empty(0, np.int64)
    return none, none, np.empty(0, np.uint64)


def anchors(
    data: np.ndarray, length: int = LENGTH, gram: int = GRAM, sums: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, anchor hash) of each run of starts of ``length`` bytes that share an anchor, leftmost on ties."""
    if len(data) < length:
        return _no_runs()
    gram = min(gram, length)
    return _lowest(gram_hashes(data, gram, sums), length - gram + 1)


def word_hashes(data: np.ndarray, sums: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A mixed hash of every word ``[^\\x20\\x09-\\x0D]+``, wherever it stands."""
    sums, power = sums or _byte_sums(data)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = (data != 0x20) & ((data - np.uint8(9)) > 4)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return _mixed((sums[end] - sums[start]) * power[start])


def _sequences(sums: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """A mixed hash of every ``n`` words."""
    sums, power = sums
    return _mixed((sums[n:] - sums[:-n]) * power[: len(sums) - n])


def word_anchors(words: np.ndarray, passage: int = PASSAGE, gram: int = WORD_GRAM, sums: tuple[np.ndarray, np.ndarray] | None = None):
    """What ``anchors`` gives, for starts of ``passage`` words among the hashes ``words``."""
    if len(words) < passage:
        return _no_runs()
    gram = min(gram, passage)
    return _lowest(_sequences(sums or _sums(words), gram), passage - gram + 1)


# ---- suffix arrays

def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least their first ``depth`` bytes, and each suffix's place.

    Larsson-Sadakane: sorted by eight bytes first, then groups of equal rank are refined by the rank
    of what follows, twice as far each time; groups of one are never touched again.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(words)
    new = np.concatenate(([True], words[order][1:] != words[order][:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = heads  # a group's rank is where it begins
    h = 8
    while h < depth:
        group = rank[order]
        alone = np.concatenate((group[1:] != group[:-1], [True])) & np.concatenate(([True], group[1:] != group[:-1]))
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        own = order[places]
        key = rank[own] * (n + 2) + rank[np.minimum(own + h, n)] + 1
        by_key = np.argsort(key)
        own, key = own[by_key], key[by_key]
        order[places] = own
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        h *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """Bytes that each sorted suffix shares with the one before it, up to ``limit``.

    Kasai's rule: a suffix shares at most one byte less than the suffix that begins one byte earlier.
    It holds where what follows that suffix's neighbour stands before the suffix. Neighbours that the
    order leaves open may break this (the text goes on with the smaller byte in the latter); there
    counting begins at 0. All pieces (``firsts``, ``sizes``) advance side by side, eight bytes at a time, each
    to its next suffix as soon as one is counted.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + n + 1]
    out = np.zeros(n, np.int32)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    carries = np.zeros(n + 1, bool)  # whether the suffix that begins one byte earlier tells anything
    carries[1:n] = (place[np.minimum(before[:-1] + 1, n - 1)] <= place[1:]) & (before[1:] >= 0)
    p, end = firsts[sizes > 0], (firsts + sizes)[sizes > 0]
    shared = np.zeros(len(p), np.int64)
    while len(p):
        q = before[p]
        a, b = p + shared, q + shared
        run = 8 - np.searchsorted(_BYTES, words[a] ^ words[b], side="right")
        run = np.minimum(run, np.minimum(n - np.maximum(a, b), limit - shared))
        run[q < 0] = 0
        shared += run
        done = (run < 8) | (shared >= limit)
        out[place[p[done]]] = shared[done]
        p = p + done
        shared = np.where(done, np.where(carries[p], np.maximum(shared - 1, 0), 0), shared)
        if (live := p < end).sum() < len(p):
            p, end, shared = p[live], end[live], shared[live]
    return out


class Shard:
    """The pieces of a shard, sorted."""

    def __init__(self, pieces: list[bytes], length: int):
        self.length = length
        self.sizes = np.array([len(p) for p in pieces])
        self.firsts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.raw = b"".join(pieces)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.order, self.place = suffix_array(self.data, len(self.data))  # to the end: where the order is open prefixes are counted from 0
        prefixes = common_prefixes(self.data, self.order, self.place, self.firsts, self.sizes, length)
        self.run = np.cumsum(prefixes < length)  # suffixes that share ``length`` bytes have the same number
        whole = np.zeros(len(self.data), bool)  # starts from which ``length`` bytes lie in one piece
        for f, s in zip(self.firsts.tolist(), self.sizes.tolist()):
            whole[f : f + max(0, s - length + 1)] = True
        self.whole = whole[self.order]
        n_whole = np.bincount(self.run[self.whole], minlength=len(self.data) + 1)
        self.twice = np.zeros(len(self.data), bool)
        self.twice[self.order] = self.whole & (n_whole[self.run] > 1)

    def meets(self, other: Shard) -> np.ndarray:
        """Starts whose ``length`` bytes begin somewhere in ``other``; only those single here are looked up."""
        found = np.zeros(len(self.data), bool)
        here, there = np.flatnonzero(self.whole), np.flatnonzero(other.whole)
        runs, first = np.unique(self.run[here], return_index=True)
        theirs = other.order[there]
        n = self.length
        for r, k in zip(runs.tolist(), here[first].tolist()):
            at = int(self.order[k])
            key = self.raw[at : at + n]
            low, high = 0, len(theirs)
            while low < high:
                mid = (low + high) // 2
                if other.raw[theirs[mid] : theirs[mid] + n] < key:
                    low = mid + 1
                else:
                    high = mid
            if low < len(theirs) and other.raw[theirs[low] : theirs[low] + n] == key:
                found[at] = True
        hit = np.zeros(len(self.data) + 1, bool)
        hit[self.run[self.place[np.flatnonzero(found)]]] = True
        found[self.order] = self.whole & hit[self.run]
        return found


def _ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of True as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], starts.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


# ---- over tables

def _anchor_rows(docs: DataFrame, length: int, passage: int) -> DataFrame:
    """``(anchor, key, n)``: how often a text has an anchor of bytes, 1 for anchors of words; ``n`` of a null anchor counts the text's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, keys, counts, sizes = [], [], [], []
            names = batch.column(0).to_pylist()
            for key, text in zip(names, batch.column(1).to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8)
                sums = _byte_sums(data)
                words = word_hashes(data, sums)
                sizes.append(len(words))
                _, _, h = anchors(data, length, sums=sums)
                own, n = np.unique(h, return_counts=True)
                said = np.unique(word_anchors(words, passage)[2])
                hashes += [own, said]
                keys.append(np.full(len(own) + len(said), key, np.int64))
                counts += [n, np.ones(len(said), n.dtype)]
            if hashes:
                anchor = pa.chunked_array([pa.array(np.concatenate(hashes).view(np.int64)), pa.nulls(len(sizes), pa.int64())]).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [anchor, pa.array(np.concatenate([*keys, names]), pa.int64()), pa.array(np.concatenate([*counts, sizes]).astype(np.int32))],
                    ["anchor", "key", "n"])

    return docs.mapInArrow(run, "anchor long, key long, n int")


def _piece_rows(texts: DataFrame, length: int, passage: int) -> DataFrame:
    """``(anchor, digest, t, first, data, windows)`` for each of a text's ``hashes``; ``first`` is where the piece begins in the text.

    Pieces of bytes have ``data``. Pieces of words have the hashes of all their stretches of ``passage`` words instead, and count in words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"anchor": [], "digest": [], "t": [], "first": [], "data": [], "windows": []}

            def add(*values) -> None:
                for column, value in zip(rows.values(), values):
                    column.append(value)

            for t, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                sums, asked = _byte_sums(data), np.array(wanted, np.int64)
                first, last, h = anchors(data, length, sums=sums)
                h = h.view(np.int64)
                for k in np.flatnonzero(np.isin(h, asked)).tolist():
                    piece = raw[first[k] : last[k] + length]
                    add(int(h[k]), hashlib.blake2b(piece, digest_size=16).digest(), t, int(first[k]), piece, None)
                words = word_hashes(data, sums)
                word_sums = _sums(words)
                first, last, h = word_anchors(words, passage, sums=word_sums)
                h = h.view(np.int64)
                if len(at := np.flatnonzero(np.isin(h, asked))):
                    windows = _sequences(word_sums, passage).view(np.int64)
                    for k in at.tolist():
                        piece = windows[first[k] : last[k] + 1]
                        add(int(h[k]), hashlib.blake2b(piece.tobytes(), digest_size=16, person=b"words").digest(), t, int(first[k]), None, piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["anchor"], pa.int64()), pa.array(rows["digest"], pa.binary()), pa.array(rows["t"], pa.int64()),
                 pa.array(rows["first"], pa.int64()), pa.array(rows["data"], pa.binary()), pa.array(rows["windows"], pa.list_(pa.int64()))], list(rows))

    return texts.mapInArrow(run, "anchor long, digest binary, t long, first long, data binary, windows array<long>")


def _span(last: Column) -> Column:
    """A piece's starts up to ``last`` as its spans."""
    return F.array(F.struct(F.lit(0).cast("long").alias("a"), last.cast("long").alias("b"))).alias("spans")


def _passages(pieces: DataFrame) -> DataFrame:
    """``(anchor, digest, spans)``: starts in a piece from which a whole passage also stands in another text, of ``pieces(anchor, digest, t, windows)``."""
    distinct = pieces.groupBy("anchor", "digest").agg(F.first("windows").alias("windows"), F.min("t").alias("low"), F.max("t").alias("high"))
    only = F.when(F.col("low") == F.col("high"), F.col("low")).alias("t")  # null: in several texts
    distinct = durable(distinct.select("anchor", "digest", "windows", only), "distinct-passages")
    shared = distinct.filter("t is null").select("anchor", "digest", _span(F.size("windows") - 1))
    mixed = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.count("t").alias("open")).filter("n > 1 and open > 0")
    each = distinct.join(mixed.select("anchor"), "anchor").select("anchor", "digest", "t", F.posexplode("windows").alias("a", "window"))
    same = Window.partitionBy("anchor", "window")
    met = (F.count(F.lit(1)).over(same) > F.count("t").over(same)) | (F.min("t").over(same) < F.max("t").over(same))
    at = F.col("a").cast("long")
    found = each.withColumn("met", met).filter("met and t is not null").groupBy("anchor", "digest").agg(F.collect_list(F.struct(at.alias("a"), at.alias("b"))).alias("spans"))
    return shared.unionByName(found)


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _repeats(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """``(anchor, digest, spans)``: starts in a piece from which ``length`` bytes also stand in another of ``pieces(anchor, digest, data, n)``.

    Anchors all of whose pieces stand in two places need no answer.
    """
    per = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("data")).alias("bytes"), F.min("n").alias("least")).filter("n > 1 and least = 1")
    per = durable(per.select("anchor", "bytes", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("c")), "anchors")
    work = per.agg(F.sum(F.col("bytes") * F.col("c"))).first()[0] or 0  # an anchor's pieces go to each of its shards
    tasks = min(MAX_TASKS, max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), work // TASK_BYTES + 1))
    own = F.pmod(F.xxhash64("digest"), F.col("c")).cast("int")
    dealt = pieces.join(per.drop("bytes"), "anchor").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    dealt = dealt.select(
        "anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"), "digest", "data")
    dealt = dealt.repartition(tasks, "anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")

    def solve(rows: list) -> pa.RecordBatch:
        """Rows of whole anchors, or of one pair of shards of an anchor."""
        anchor, i, j = rows[0][:3]
        out = []
        if i == j:
            shard = Shard([r[5] for r in rows], length)
            out = [(shard, rows, shard.twice)]
        else:
            sides = [[r for r in rows if r[3]], [r for r in rows if not r[3]]]
            if all(sides):
                a, b = (Shard([r[5] for r in side], length) for side in sides)
                out = [(a, sides[0], a.meets(b)), (b, sides[1], b.meets(a))]
        ids, digests, spans = [], [], []
        for shard, own_rows, found in out:
            for row, f, s in zip(own_rows, shard.firsts.tolist(), shard.sizes.tolist()):
                if ranges := _ranges(found[f : f + s]):
                    ids.append(row[0])
                    digests.append(row[4])
                    spans.append([{"a": a, "b": b} for a, b in ranges])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(spans, _SPANS)], ["anchor", "digest", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # whole groups of one shard each, solved together
        group: list = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal group, held, size
            if group and group[0][1] != group[0][2]:
                yield solve(group)
            else:
                held += group
                size += sum(len(r[5]) for r in group)
            if held and size >= shard_bytes:
                yield solve(held)
                held, size = [], 0
            group = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:3] != group[0][:3]:
                    yield from close()
                group.append(row)
        if group:
            yield from close()
        if held:
            yield solve(held)

    return dealt.mapInArrow(run, "anchor long, digest binary, spans array<struct<a:long,b:long>>")


def _runs(ranges: list[tuple[int, int]], length: int) -> list[list[int]]:
    """What stretches of ``length`` cover that begin within ``ranges`` of first and last starts, as [start, end]."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b + length)
        else:
            runs.append([a, b + length])
    return runs


def _kept(texts: DataFrame, length: int, passage: int) -> DataFrame:
    """``(sha, n_removed, n_spans, kept_sha256, removed, n_passage_words)`` from ``texts(sha, text, ranges)``.

    A range holds the first and last start of repeats, in words or bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, removed, n_spans, kept, cut, passages = [], [], [], [], [], []
            for sha, text, ranges in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw, out, at = text.encode(), hashlib.sha256(), 0
                runs = _runs([(r["a"], r["b"]) for r in ranges if not r["words"]], length)
                for a, b in runs:
                    out.update(raw[at:a])
                    at = b
                out.update(raw[at:])
                shas.append(sha)
                removed.append(sum(b - a for a, b in runs))
                n_spans.append(len(runs))
                kept.append(out.hexdigest())
                cut.append(",".join(f"{a}:{b}" for a, b in runs))
                passages.append(sum(b - a for a, b in _runs([(r["a"], r["b"]) for r in ranges if r["words"]], passage)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shas, pa.string()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string()), pa.array(cut, pa.string()),
                 pa.array(passages, pa.int64())], ["sha", "n_removed", "n_spans", "kept_sha256", "removed", "n_passage_words"])

    return texts.mapInArrow(run, "sha string, n_removed long, n_spans long, kept_sha256 string, removed string, n_passage_words long")


def deduplicated(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES, passage: int = PASSAGE
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, removed, n_passage_words)`` of every row.

    ``removed`` lists start:end in bytes, ends exclusive. ``n_passage_words`` counts the words that stand in passages
    of ``passage`` words or more which also stand in another row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), body.alias("text"), F.sha2(body, 256).alias("sha"))
    known = durable(rows.select("id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    long = rows.filter(F.octet_length("text") >= min(length, 2 * passage - 1))
    # which anchors stand in two texts, or twice in one
    found = durable(_anchor_rows(long.select(F.xxhash64("sha").alias("key"), "text"), length, passage), "anchor-rows")
    same = Window.partitionBy("anchor")
    seen = found.filter("anchor is not null").select(
        "anchor", "key", F.min("key").over(same).alias("a"), F.max("key").over(same).alias("b"), F.max("n").over(same).alias("n"))
    own = seen.filter("a <> b or n > 1").groupBy("key").agg(F.collect_set("anchor").alias("hashes"))
    # each text once, with the anchors to look at
    once = long.groupBy("sha").agg(F.first("text").alias("text"))
    texts = once.withColumn("key", F.xxhash64("sha")).join(own, "key").select(F.monotonically_increasing_id().alias("t"), "sha", "text", "hashes")
    texts = durable(texts, "candidates")
    every_piece = durable(_piece_rows(texts.select("t", "text", "hashes"), length, passage), "pieces")
    pieces = every_piece.filter("data is not null")
    distinct = durable(pieces.groupBy("anchor", "digest").agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("n")), "distinct-pieces")
    repeats = durable(_repeats(distinct, length, shard_bytes), "repeats")
    # a piece that stands in two places is repeated as a whole
    owners = every_piece.select("digest", "t", "first")
    parts = distinct.filter("n > 1").select("anchor", "digest", _span(F.length("data") - length))
    every = parts.unionByName(repeats.join(parts.select("anchor", "digest"), ["anchor", "digest"], "left_anti")).withColumn("words", F.lit(False))
    said = _passages(every_piece.filter("windows is not null").select("anchor", "digest", "t", "windows"))
    every = durable(every.unionByName(said.withColumn("words", F.lit(True))), "spans")
    placed = owners.join(every.drop("anchor"), "digest").select("t", "words", F.explode("spans").alias("s"), "first")
    start = F.struct("words", (F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b")).alias("b"))
    ranges = placed.groupBy("t").agg(F.collect_set(start).alias("ranges"))
    cut = durable(_kept(texts.select("t", "sha", "text").join(ranges, "t").select("sha", "text", "ranges"), length, passage), "cut")
    sizes = found.filter("anchor is null").groupBy("key").agg(F.max("n").cast("long").alias("n_words"))
    copies = known.groupBy("sha").count().filter("count > 1").select("sha", F.xxhash64("sha").alias("key"), F.lit(True).alias("copied"))
    facts = durable(cut.join(copies.join(sizes, "key", "left").drop("key"), "sha", "full"), "facts")
    copied = F.coalesce("copied", F.lit(False))
    whole = copied & (F.col("n_bytes") >= length)
    n_removed = F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
    n_passage_words = F.when(copied & (F.col("n_words") >= passage), F.col("n_words")).otherwise(F.coalesce("n_passage_words", F.lit(0)))
    return known.join(facts, "sha", "left").select(
        "id", "n_bytes", n_removed.alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        (F.col("n_bytes") - n_removed).alias("n_kept"),
        F.when(whole, F.concat(F.lit("0:"), F.col("n_bytes").cast("string"))).otherwise(F.coalesce("removed", F.lit(""))).alias("removed"),
        n_passage_words.alias("n_passage_words"))
