import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from dialogprep.llm import suffixes
from tests.llm.cases import documents, empty, prose, texts


def brute(raws, length):
    seen = Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        m = np.zeros(len(b) + 1, np.int8)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                m[i : i + length] = 1
        kept = np.frombuffer(b, np.uint8)[m[: len(b)] == 0].tobytes()
        out.append((len(b), int(m.sum()), int((np.diff(np.concatenate(([0], m))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def rows():
    r = random.Random(6)
    shared = [prose(500 + k, 40) for k in range(4)]
    out = list(texts()) + [(24, "ab" * 700, "en", "s"), (None, "ab" * 300 + "é" * 300, "en", "s"), (27, "aaaa" * 500, "en", "s")]
    for k in range(14):
        parts = [prose(600 + k, 30), r.choice(shared), prose(700 + k, 20), r.choice(shared)[: r.randint(150, 230)], "ü" * r.randint(0, 3)]
        out.append((100 + k, " ".join(parts), "en", "s"))
    return [(i, t if t is None or len(t) < 9000 else t[:9000], *x) for i, t, *x in out]


@pytest.mark.parametrize("length, shard_bytes", [(100, 1 << 18), (100, 900), (400, 1 << 18)])
def test_rows_equal_brute_force(spark, length, shard_bytes):
    data = rows()
    got = suffixes.deduplicated(documents(spark, data, clash=["sha", "key", "anchor"]), length=length, shard_bytes=shard_bytes).collect()
    want = brute([(t or "").encode() for _, t, *_ in data], length)
    assert sorted((str(i), *w) for (i, *_), w in zip(data, want)) == sorted((str(r.id), *tuple(r)[1:5]) for r in got)
    for r in got:
        runs = [tuple(map(int, x.split(":"))) for x in r.removed.split(",") if x]
        assert len(runs) == r.n_spans and sum(b - a for a, b in runs) == r.n_removed == r.n_bytes - r.n_kept
    assert length > 100 or any(0 < w[1] < w[0] for w in want)


def test_empty_table(spark):
    assert suffixes.deduplicated(empty(spark)).count() == 0


def test_suffix_array_and_prefixes():
    r = random.Random(2)
    for size in (1, 2, 50, 400):
        raw = bytes(r.choice(b"ab") for _ in range(size)) + b"abab" * 10
        data = np.frombuffer(raw, np.uint8)
        order, place = suffixes.suffix_array(data, len(raw) + 1)
        assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
        assert (order[place] == np.arange(len(raw))).all()
        got = suffixes.common_prefixes(data, order, place, np.array([0, size]), np.array([size, len(raw) - size]), 30)
        for k in range(1, len(raw)):
            a, b = raw[order[k - 1] :], raw[order[k] :]
            assert got[k] == min(30, next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))


def test_anchors_depend_on_content_alone():
    r = np.random.default_rng(1)
    inner = r.integers(97, 100, 900, dtype=np.uint8)
    for before in (0, 1, 333):
        data = np.concatenate([r.integers(97, 123, before, dtype=np.uint8), inner, r.integers(97, 123, 50, dtype=np.uint8)])
        first, last, h = suffixes.anchors(data, 400, 160)
        assert first[0] == 0 and last[-1] == len(data) - 400 and (first[1:] == last[:-1] + 1).all()
        at = dict((p - before, x) for f, l, x in zip(first, last, h) for p in range(f, l + 1))
        if before == 0:
            want = at
        assert all(at[p] == want[p] for p in range(len(inner) - 400 + 1))


def test_shards_merge_by_binary_search():
    r = random.Random(8)
    word = lambda: bytes(r.choice(b"abcdefgh") for _ in range(60))
    common = [word() for _ in range(5)]
    pieces = [word() + r.choice(common) + word() for _ in range(30)]
    a, b = suffixes.Shard(pieces[:15], 50), suffixes.Shard(pieces[15:], 50)
    for own, other in ((a, b), (b, a)):
        found = own.meets(other)
        for p in np.flatnonzero(found):
            assert own.raw[p : p + 50] in other.raw
        starts = [f + k for f, s in zip(own.firsts.tolist(), own.sizes.tolist()) for k in range(s - 49)]
        inside = [q for f, s in zip(other.firsts.tolist(), other.sizes.tolist()) for q in [other.raw[f + k : f + k + 50] for k in range(s - 49)]]
        assert {int(p) for p in np.flatnonzero(found)} == {p for p in starts if own.raw[p : p + 50] in set(inside)}


def test_long_shared_stretches_whose_order_ends_early():
    """Pairs of pieces share 520 to 640 bytes, more than the order looks at, and go on either way; no other 400 bytes are repeated."""
    r = random.Random(9)
    text = lambda n: bytes(r.choice(b"ab") for _ in range(n))
    for _ in range(8):
        pieces = []
        for _ in range(20):
            shared = text(r.randint(520, 640))
            pieces += [text(r.randint(0, 60)) + shared + b"b" + text(r.randint(400, 500)), text(r.randint(0, 60)) + shared + b"a" + text(r.randint(400, 500))]
        r.shuffle(pieces)
        shard = suffixes.Shard(pieces, 400)
        seen = Counter(p[k : k + 400] for p in pieces for k in range(len(p) - 399))
        want = [f + k for p, f in zip(pieces, shard.firsts.tolist()) for k in range(len(p) - 399) if seen[p[k : k + 400]] > 1]
        assert np.flatnonzero(shard.twice).tolist() == want


def passage_words(rows, passage):
    """Words in stretches of ``passage`` words that another row has too."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in rows]
    windows = [[tuple(w[i : i + passage]) for i in range(len(w) - passage + 1)] for w in split]
    owners = Counter(x for ws in windows for x in set(ws))
    out = []
    for w, ws in zip(split, windows):
        hit = np.zeros(len(w), bool)
        for i, x in enumerate(ws):
            if owners[x] > 1:
                hit[i : i + passage] = True
        out.append(int(hit.sum()))
    return out


@pytest.mark.parametrize("passage", [50, 12, 20])
def test_passages_in_other_documents_are_counted(spark, passage):
    """Short words too: fifty of them take far less than 400 bytes. White space differs; repeats inside one document don't count."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abü") for _ in range(r.randint(1, 3)))
    said = lambda n: [word() for _ in range(n)]
    shared = [said(n) for n in (49, 50, 51, 64, 130)]
    data = [(24, " ".join(["x"] * 300), "en", "s"), (25, "y " * 49 + "y\n" + "y " * 60, "en", "s")]
    data += [(30 + i, " ".join(said(200)), "en", "s") for i in (0, 1) for _ in range(1 + i)]  # the latter is a whole copy
    for k in range(40):
        ws = said(r.randint(0, 60)) + r.choice(shared) + said(r.randint(0, 60)) + r.choice(shared)[: r.randint(30, 60)]
        data.append((100 + k, r.choice([" ", "\n", "\t "]).join(ws), "en", "s"))
    once = said(70)
    data += [(200, " ".join(once + ["-"] + once), "en", "s"), (201, None, "en", "s"), (202, "", "en", "s"), *rows()]
    data += [(300, "of " * 55, "en", "s"), (301, "of " * 55, "en", "s")]  # a copy below 400 bytes
    got = suffixes.deduplicated(documents(spark, data), passage=passage).collect()
    want = passage_words([t for _, t, *_ in data], passage)
    assert sorted((str(i), w) for (i, *_), w in zip(data, want)) == sorted((str(r.id), r.n_passage_words) for r in got)
    assert any(r.n_passage_words and not r.n_removed for r in got)
    assert sorted((str(i), *w) for (i, *_), w in zip(data, brute([(t or "").encode() for _, t, *_ in data], 400))) == sorted((str(r.id), *tuple(r)[1:5]) for r in got)


def test_prefixes_take_few_rounds(monkeypatch):
    """Near copies share more than the limit; where their order was open each start was counted from 0 again."""
    r = random.Random(3)
    base = bytes(r.choice(b"abcdefgh ") for _ in range(640))
    pieces = [base[:k] + b"#%d" % k + base[k:] for k in range(3, 60, 3)]
    calls, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: calls.append(1) or search(*a, **k))
    suffixes.Shard(pieces, 400)
    assert 0 < len(calls) < 2 * 643
