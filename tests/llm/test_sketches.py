import hashlib
import re

import pytest
from pyspark.sql import functions as F

from dialogprep.llm import sketches
from tests.llm.cases import documents, empty, prose, texts

PARAGRAPH = re.compile(sketches.PARAGRAPH)


def alike(a, b):
    a, b = set(PARAGRAPH.findall(a)), set(PARAGRAPH.findall(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_rows_equal_brute_force(spark):
    rows = [r for r in texts() if r[0] != 23] + [(80, "\n".join(prose(800 + k, 20) for k in range(90)), "en", "s")]
    got = sketches.fingerprinted(documents(spark, rows, clash=["key", "next", "digests", "n_chars"])).collect()
    assert len(got) == len(rows)
    known = {}
    for i, t, *_ in rows:
        known.setdefault(-1 if i is None else i, []).append(t or "")
    ids = sorted(known)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for k, i in enumerate(ids):
        after = min(known[ids[(k + 1) % len(ids)]], key=sha)
        for t in known[i]:
            q = len(t) // 4
            e = t[: len(t) - q] + after[:q]
            want.append((i, len(t), sha(e), round(alike(t, e), 9), round(alike(t, after), 9)))
    have = [(-1 if r.id is None else r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have) == sorted(want)
    prints = {}
    for i, t, *_ in rows:
        prints.setdefault(t or "", set()).update(r.fingerprint for r in got if r.id == i and r.n_chars == len(t or ""))
    assert all(len(p) <= 2 for p in prints.values())


def test_equal_texts_have_equal_fingerprints(spark):
    docs = documents(spark, [(1, "one. two.\nthree", "en", "s"), (2, "one. two.\nthree", "en", "s"), (3, "other", "en", "s"), (4, None, "en", "s"), (5, "", "en", "s")])
    got = {r.id: r for r in sketches.fingerprinted(docs).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint and got[4].fingerprint == got[5].fingerprint
    assert (got[1].near_next, got[4].near_next, got[3].near_next) == (1.0, 1.0, 0.0)
    assert sketches.fingerprinted(empty(spark)).count() == 0
    alone = sketches.fingerprinted(documents(spark, [(1, "abcdefgh", "en", "s")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


@pytest.mark.parametrize("n, common", [(0, 0), (3, 10), (12, 500), (40, 0), (400, 20)])
def test_peeling_recovers_the_difference(spark, n, common):
    """Small differences come out of one group of cells; larger ones need the repeats of ``likeness``."""
    keys = lambda tag, k: F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: sketches._checked(F.xxhash64(F.lit(tag), i).bitwiseAND(F.lit(~0xFFFF).cast("long")))) if k else F.array().cast("array<bigint>")
    rows = spark.range(1).select(keys("c", common).alias("c"), keys("a", n).alias("a"), keys("b", n // 2).alias("b"))
    rows = rows.select("a", "b", F.concat("c", "a").alias("x"), F.concat("c", "b").alias("y"))
    rows = rows.withColumns({"sx": sketches.sketch(F.col("x")), "sy": sketches.sketch(F.col("y"))})
    first = rows.withColumn("p", sketches.peel(sketches.subtract(F.col("sx"), F.col("sy")))).first()
    assert first.p.ok == (n <= 40)
    if first.p.ok:
        assert (sorted(first.p.plus), sorted(first.p.minus)) == (sorted(first.a), sorted(first.b))
    near = sketches.likeness(rows, "x", "y", "sx", "sy", "near").first().near
    assert near == pytest.approx(common / (common + n + n // 2) if common + n else 1.0)


def test_one_line_is_cut_at_sentence_ends(spark):
    """The lengths are written out, so that coarser paragraphs are noticed."""
    short, long = "a line whose first sentence has over sixty-four letters or so in all. And twenty-four more here.", "word " * 60
    docs = documents(spark, [(1, short, "en", "s"), (2, long, "en", "s"), (3, "other", "en", "s")])
    got = {r.id: r for r in sketches.fingerprinted(docs).collect()}
    assert got[1].near_edited == pytest.approx(1 / 3) and got[2].near_edited == pytest.approx(1 / 3)
