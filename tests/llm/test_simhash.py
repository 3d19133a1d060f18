import numpy as np
import xxhash
from pyspark.sql import functions as F

from dialogprep.llm import simhash
from tests.llm.cases import documents, empty, prose, texts


def fingerprint(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(points, limit):
    """Smallest id reachable, by brute force, for {id: fingerprint}."""
    root = {i: i for i in points}
    for _ in points:
        for i in points:
            for j in points:
                if bin(points[i] ^ points[j]).count("1") <= limit:
                    root[i] = min(root[i], root[j])
    return root


def test_close_pairs_equal_brute_force():
    r = np.random.default_rng(5)
    for n, lanes, limit in ((30, 1, 4), (900, 1, 4), (700, 2, 9), (65, 1, 0)):
        centres = r.integers(0, 2**63, (12, lanes), dtype=np.uint64)
        noise = np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (n, 3, lanes), dtype=np.uint64), axis=1)
        v = np.unique(centres[r.integers(0, 12, n)] ^ noise, axis=0)
        i, j = simhash.close_pairs(v, limit)
        far = np.bitwise_count(v[:, None] ^ v[None]).sum(-1)
        a, b = np.nonzero(np.triu(far <= limit, 1))
        assert set(zip(a.tolist(), b.tolist())) == {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())}


def test_documents_equal_brute_force(spark):
    rows = texts() + [(40 + k, prose(900, 300) + (" tail" * k), "en", "s") for k in range(6)]
    got = simhash.near_duplicates(documents(spark, rows, clash=["fp", "id", "node"])).select("id", simhash.as_hex(F.col("fp")).alias("h"), "component_id").collect()
    assert len(got) == len(rows)
    assert sorted((str(r.id), r.h) for r in got) == sorted((str(i), f"{fingerprint(t, 4):016x}") for i, t, *_ in rows)
    # ids with two texts link both: brute force over fingerprints, named by smallest id
    points = {}
    for i, t, *_ in rows:
        if i is not None:
            f = fingerprint(t, 4)
            points[f] = min(i, points.get(f, i))
    want = groups({f: f for f in points}, 4)
    least = {}
    for f in points:
        least[want[f]] = min(points[f], least.get(want[f], points[f]))
    by_text = {(r.id, r.h): r.component_id for r in got}
    for i, t, *_ in rows:
        f = fingerprint(t, 4)
        assert by_text[(i, f"{f:016x}")] == (None if i is None else least[want[f]])


def test_chunks_of_hot_groups_lose_no_link(spark):
    r = np.random.default_rng(2)
    v = np.unique(np.uint64(0x0123456789ABCDEF) ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (300, 3), dtype=np.uint64), axis=1))
    fps = spark.createDataFrame([(int(k), bytearray(int(x).to_bytes(8, "little"))) for k, x in enumerate(v)], "node long, fp binary")
    whole = simhash.components(simhash.links(fps, 4)).collect()
    parts = simhash.components(simhash.links(fps, 4, group_rows=16)).collect()
    single = simhash.components(simhash.links(fps, 4, agree=1)).collect()
    three = simhash.components(simhash.links(fps, 4, agree=3, group_rows=4)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) == sorted(map(tuple, single)) == sorted(map(tuple, three)) and whole


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (200, 200)], "a long, b long")
    got = dict(map(tuple, simhash.components(edges).collect()))
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100}


def test_one_of_each_group_stays(spark):
    base = prose(77, 400).split()
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (30, 90, 200)]
    rows = [(9, " ".join(base), "en", "s"), *[(i, t, "en", "s") for i, t in zip((3, 11, 12), near)], (13, prose(78, 400), "en", "s"), (13, prose(78, 400), "en", "s"), (None, None, "en", "s")]
    kept = simhash.first_of_each(documents(spark, rows, clash=["fp"]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["13", "3", "None"]
    assert kept.columns == documents(spark, rows, clash=["fp"]).columns
    assert simhash.first_of_each(empty(spark)).count() == 0


def test_kept_documents_equal_brute_force(spark):
    """Chains of small changes, of which some stay within the limit: one of each group of fingerprints stays."""
    import random

    r = random.Random(4)
    rows = []
    for k in range(25):
        words = prose(300 + k, r.choice((40, 150, 600))).split()
        for n in range(6):
            rows.append((1000 - 7 * (6 * k + n), " ".join(words), "en", "s"))
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    rows += [(5000, "", "en", "s"), (5001, None, "en", "s"), (5002, " \n", "en", "s")]
    points = {i: fingerprint(t, 4) for i, t, *_ in rows}
    root = groups(points, 4)
    assert 30 < len(set(root.values())) < 140
    got = simhash.first_of_each(documents(spark, rows, clash=["row", "content", "_k", "_sha", "component_id"])).collect()
    assert sorted(x.doc_id for x in got) == sorted(set(root.values()))


def test_repeated_ids_keep_the_least_text(spark):
    rows = [(5, t, "en", "s") for t in ("b " + prose(1, 50), "a " + prose(2, 50), "a " + prose(2, 50))] + [(6, None, "en", "s"), (6, prose(3, 50), "en", "s")]
    got = simhash.first_of_each(documents(spark, rows, clash=["_k", "text_", "id"])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(5, "a " + prose(2, 50)), (6, None)]


def test_rows_made_stay_proportional(spark):
    """What is compared grows with the fingerprints, not with their square."""
    r = np.random.default_rng(3)
    made = {}
    for n in (2_000, 40_000):
        v = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n, dtype=np.uint64))
        fps = spark.createDataFrame([(k, bytearray(int(x).to_bytes(8, "little"))) for k, x in enumerate(v)], "node long, fp binary")
        made[n] = simhash._meetings(fps, 4, 2, simhash.GROUP_ROWS).count() / len(v)
    assert made[2_000] == made[40_000] == 15


def test_another_text_under_an_id_stays(spark):
    rows = [(3, prose(77, 300), "en", "s"), (5, prose(77, 300) + " end", "en", "s"), (5, prose(78, 300), "en", "s")]
    got = simhash.first_of_each(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(3, rows[0][1]), (5, rows[2][1])]
