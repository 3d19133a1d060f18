"""Encoding to subword pieces by unigram Viterbi over a double-array trie, and decoding.

Pieces come from a SentencePiece model file. Their log scores are those of the file for a unigram
model; a merge model stores only ranks, which become log probabilities by Zipf's law. A code point
that no piece covers costs ten more than the worst piece and is written as its UTF-8 bytes.

White space is marked as in the model: each space belongs to what follows it and one is put before
the text. The trie holds the marker as a plain space, so a marker character in the text itself
goes through byte fallback and every text decodes to itself. Where no piece has a marker
behind its first other character (checked when the model is read), a text falls apart at its spaces,
and the best path of the whole is the best paths of the parts: parts are solved once per task, all
new parts of a batch together. Of equally good paths the one whose last piece starts first wins.

Null text counts as empty and has no tokens. Rows are handled on their own: nothing is shuffled
and no key can be hot. Other columns pass through (columns named like an output are replaced).
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
#: Solved parts that a task keeps; beyond that it starts afresh. Results don't depend on it.
KEPT_PARTS = 100_000
#: Parts that are solved together.
SOLVED_PARTS = 8_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6  # fixed values: piece types of the file format
_UNIGRAM = 1


# ---- the model file

def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


@dataclass
class Model:
    """Double-array trie over the bytes of the pieces, their scores, and what decoding needs."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # piece at a node, or -1
    score: np.ndarray
    unknown: float
    byte_ids: np.ndarray
    flat: np.ndarray  # bytes of all pieces, and where each begins
    first: np.ndarray
    is_byte: np.ndarray
    prefix: bool
    splits: bool


def parse(data: bytes) -> Model:
    """The model in the bytes of a model file."""
    pieces, kind, prefix = [], _UNIGRAM, True
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, _NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, _UNIGRAM)
        elif number == 3:
            prefix = bool(dict(_fields(value)).get(3, 1))
    text = [p.replace(MARK, " ").encode() if t in (_NORMAL, _USER) else b"" for p, _, t in pieces]
    score = np.array([s for _, s, _ in pieces])
    usable = np.array([t in (_NORMAL, _USER) for _, _, t in pieces])
    if kind != _UNIGRAM:
        order = np.argsort(-score[usable], kind="stable")
        rank = np.empty(len(order))
        rank[order] = np.arange(1, len(order) + 1)
        score[usable] = -np.log(rank) - np.log((1 / rank).sum())
    byte_ids = np.full(256, -1)
    for i, (p, _, t) in enumerate(pieces):
        if t == _BYTE:
            byte_ids[int(p[1:-1], 16)] = i
            text[i] = bytes([int(p[1:-1], 16)])
    if (byte_ids < 0).any():
        raise ValueError("the model has no piece for every byte")
    base, check, value = _double_array({text[i]: i for i in np.flatnonzero(usable).tolist()})
    first = np.concatenate(([0], np.cumsum([len(t) for t in text])))
    splits = not any(re.search(rb"[^ ] ", text[i]) for i in np.flatnonzero(usable).tolist())
    return Model(base, check, value, score, float(score[usable].min() - 10), byte_ids, np.frombuffer(b"".join(text), np.uint8),
                 first, np.isin(np.arange(len(text)), byte_ids), prefix, splits)


def _double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value``: the child of node n by byte c is ``base[n] + c`` if ``check`` there is n."""
    tree: dict = {}
    for piece, i in pieces.items():
        node = tree
        for c in piece:
            node = node.setdefault(c, {})
        node[-1] = i
    size, window = 1 << 18, 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    check[0], used[0] = 0, True
    low, queue = 1, [(0, tree)]
    for at, node in queue:
        value[at] = node.get(-1, -1)
        keys = np.array(sorted(k for k in node if k >= 0), np.int64)
        if not len(keys):
            continue
        start = max(1, low - int(keys[0]))
        while True:
            if start + window + 256 >= size:
                grow = lambda a, fill: np.concatenate([a, np.full(size, fill, a.dtype)])
                base, check, value, used = grow(base, 0), grow(check, -1), grow(value, -1), grow(used, False)
                size *= 2
            fits = ~used[start + keys[0] : start + keys[0] + window]
            for k in keys[1:]:
                fits &= ~used[start + k : start + k + window]
            if fits.any():
                break
            start += window
        start += int(fits.argmax())
        base[at] = start
        used[start + keys] = True
        check[start + keys] = at
        queue += [(start + k, node[k]) for k in keys.tolist()]
        if used[low : low + window].mean() > 0.98:  # nearly full: no longer worth a look
            low += window
    return base, check, value


# ---- Viterbi

def _edges(m: Model, data: np.ndarray, starts: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, piece) of every piece found in ``data`` from each of ``starts``, which may reach up to ``stop``."""
    found = []
    at, node, end = starts, np.zeros(len(starts), np.int64), stop
    here = starts
    while len(at):
        child = m.base[node] + data[here]
        ok = (m.check[child] == node) & (m.base[node] > 0)
        at, node, here, end = at[ok], child[ok], here[ok] + 1, end[ok]
        hit = m.value[node] >= 0
        found.append((at[hit], here[hit], m.value[node[hit]]))
        more = here < end
        at, node, here, end = at[more], node[more], here[more], end[more]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(3))


def solve(m: Model, parts: list[bytes]) -> list[np.ndarray]:
    """Best token ids of each part. All parts advance together, one byte offset at a time."""
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    # positions get one slot more per part, for its end
    part = np.repeat(np.arange(len(parts)), sizes)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    start, end, piece = _edges(m, data, lead, (first + sizes)[part[lead]])
    width = np.diff(np.append(lead, len(data)))  # bytes of each code point
    single = np.zeros(len(data) + 1, bool)
    span = np.zeros(len(data) + 1, np.int64)
    span[lead] = width
    single[start[end - start == span[start]]] = True
    bare = lead[~single[lead]]
    start, end = np.concatenate([start, bare]), np.concatenate([end, bare + span[bare]])
    score = np.concatenate([m.score[piece], np.full(len(bare), m.unknown)])
    piece = np.concatenate([piece, np.full(len(bare), -1)])
    own = part[start]
    offset = start - first[own]
    order = np.argsort(offset, kind="stable")
    start, end, score, piece, own = start[order] + own[order], end[order] + own[order], score[order], piece[order], own[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(offset[order])) + 1, [len(order)]))
    best = np.full(len(data) + len(parts), -np.inf)
    back = np.full(len(best), -1)
    heads = first + np.arange(len(parts))
    best[heads] = 0
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        total = best[start[a:b]] + score[a:b]
        to = end[a:b]
        better = np.flatnonzero(total > best[to])
        best[to[better]] = total[better]
        back[to[better]] = a + better
    at, live, steps = heads + sizes, np.arange(len(parts)), []
    live = live[sizes > 0]
    at = at[live]
    while len(live):
        edge = back[at]
        steps.append((live, edge))
        at = start[edge]
        more = at > heads[live]
        at, live = at[more], live[more]
    if not steps:
        return [np.empty(0, np.int32) for _ in parts]
    who = np.concatenate([s[0] for s in steps])
    edge = np.concatenate([s[1] for s in steps])
    order = np.lexsort((start[edge], who))
    who, edge = who[order], edge[order]
    ids, length = piece[edge], end[edge] - start[edge]
    times = np.where(ids < 0, length, 1)
    out = np.repeat(ids, times)
    which = np.repeat(np.arange(len(ids)), times)
    inside = np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times)
    bare = out < 0
    out[bare] = m.byte_ids[data[(start[edge] - who)[which[bare]] + inside[bare]]]
    bounds = np.cumsum(np.bincount(who, weights=times, minlength=len(parts)).astype(np.int64))
    return np.split(out.astype(np.int32), bounds[:-1])


class Encoder:
    """Encodes texts, remembering the parts it has solved."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def parts(self, text: str) -> list[bytes]:
        raw = text.encode()
        if not raw:
            return []
        raw = b" " + raw if self.model.prefix else raw
        if not self.model.splits:
            return [raw]
        if raw[0] == 32 and b"  " not in raw and raw[-1] != 32:
            return raw[1:].split(b" ")  # each is preceded by one space
        return [p[1:] if p[0] == 32 else b"\0" + p for p in re.findall(rb" +[^ ]*|[^ ]+", raw)]

    def whole(self, part: bytes) -> bytes:
        """The bytes that a part stands for."""
        return part if not self.model.splits else part[1:] if part[:1] == b"\0" and not self.model.prefix else b" " + part

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [self.parts(t or "") for t in texts]
        if len(self.known) > KEPT_PARTS:
            self.known = {}
        new = list(set().union(*cut) - self.known.keys())
        for k in range(0, len(new), SOLVED_PARTS):
            some = new[k : k + SOLVED_PARTS]
            self.known.update(zip(some, (ids.tobytes() for ids in solve(self.model, [self.whole(p) for p in some]))))
        known = self.known
        return [np.frombuffer(b"".join([known[p] for p in parts]), np.int32) for parts in cut]


def decode(m: Model, ids: np.ndarray) -> str:
    """The text of token ids: bytes of the pieces, markers as spaces, without the one put in front."""
    first, last = m.first[ids], m.first[ids + 1]
    n = last - first
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    raw = m.flat[at].tobytes()
    return (raw[1:] if m.prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


# ---- over tables

def load(spark: SparkSession, path: str) -> Model:
    """The model at ``path``, in any store that Spark reads. Its size is that of the vocabulary."""
    if path.startswith("/"):
        path = f"file://{path}"  # vocabularies are installed on every machine
    return parse(bytes(spark.read.format("binaryFile").load(path).first()["content"]))


def encoded(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the token ids of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(docs.sparkSession, path))

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for_batch = []
            for k in range(0, max(1, len(batch)), 256):
                for_batch += encoder.encode(batch.slice(k, 256).to_pylist())
            sizes = np.concatenate(([0], np.cumsum([len(i) for i in for_batch]))).astype(np.int32)
            values = np.concatenate(for_batch) if for_batch else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(sizes), pa.array(values, pa.int32()))

    return docs.withColumn(out, run(F.col(text)))


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of each row's token ids; null ids count as none."""
    shared = rows.sparkSession.sparkContext.broadcast(load(rows.sparkSession, path))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            yield pa.array([decode(m, np.asarray(x.values) if x.is_valid else np.empty(0, np.int32)) for x in batch], pa.string())

    return rows.withColumn(out, run(F.col(ids)))


def byte_tokens(rows: DataFrame, path: str, ids: str = "ids", out: str = "n_byte_tokens") -> DataFrame:
    """Add ``out``: how many of the ids are single bytes. Byte pieces have consecutive ids."""
    m = load(rows.sparkSession, path)
    low, high = int(m.byte_ids.min()), int(m.byte_ids.max())
    return rows.withColumn(out, F.size(F.filter(ids, lambda i: i.between(low, high))).cast("long"))
