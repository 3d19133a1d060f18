import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from dialogprep.llm import manifest, queries
from tests.llm.cases import documents, empty, texts

FIELDS = ("doc_id", "source", "lang", "text")


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fan=8):
    """All levels, plainly."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + fan])) for k in range(0, len(levels[-1]), fan)])
    return levels


def siblings(levels, k, fan=8):
    out = []
    for level in levels[:-1]:
        first = k // fan * fan
        out.append((level[first:k], level[k + 1 : first + fan]))
        k //= fan
    return out


def plainly(rows, fan=8):
    """``(id, leaf, subroot, root, proof, folded)`` of each row ``(id, text, lang, source)``."""
    first = lambda v: (v is not None, v if v is not None else 0)
    by_lang = {}
    for i, t, lang, source in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if t is not None else None
        told = low if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else t
        by_lang.setdefault(lang, []).append((first(i), leaf((i, source, lang, t)), leaf((i, source, lang, told)), i))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: tree([r[1] for r in sorted(by_lang[v])], fan) for v in langs}
    top = tree([trees[v][-1][0] for v in langs], fan)
    out = Counter()
    for at, v in enumerate(langs):
        for k, (_, own, claimed, i) in enumerate(sorted(by_lang[v])):
            path = siblings(trees[v], k, fan) + siblings(top, at, fan)
            folded = claimed
            for a, b in path:
                folded = h("".join([*a, folded, *b]))
            out[i, own, trees[v][-1][0], top[-1][0], h("".join(x for a, b in path for x in a + b)), folded] += 1
    return out


def found(docs, stride=3, fan=8):
    told = [F.col(f) for f in FIELDS[:-1]] + [F.when(manifest.every_third(F.col("doc_id")), manifest.lowered(F.col("text"))).otherwise(F.col("text"))]
    got = manifest.manifest(docs, fields=FIELDS, claimed=told, stride=stride, fan=fan).collect()
    return Counter((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got)


def test_subtree_levels():
    nodes = [h(str(k)) for k in range(100)]
    for n in (1, 2, 8, 9, 64, 65, 100):
        levels = manifest.climb(nodes[:n], n, 10)
        assert levels == tree(nodes[:n])
        for k in (0, n // 2, n - 1):
            assert manifest.fold(nodes[k], manifest.steps_of(levels, k)) == levels[-1][0]
            assert (manifest.fold(h("other"), manifest.steps_of(levels, k)) == levels[-1][0]) is False


@pytest.mark.parametrize("stride,fan", [(3, 8), (1, 2), (2, 2), (2, 3)])
def test_proofs_equal_whole_trees(spark, stride, fan):
    rows = texts() + [(1000 + k, f"Text {k} ÄB", "xx", None) for k in range(90)] + [(7, None, f"l{k:02}", "s") for k in range(11)]
    docs = documents(spark, rows, clash=["digest", "tree", "pos", "n", "name"])
    assert found(docs, stride, fan) == plainly(rows, fan)


def test_more_leaves_than_a_subtree(spark):
    rows = [(k, f"Text {k}", "en" if k % 40 else "de", "s") for k in range(1300)]
    assert found(documents(spark, rows)) == plainly(rows)


def test_single_rows(spark):
    assert found(documents(spark, [(1, "A", None, None)])) == plainly([(1, "A", None, None)])
    assert found(empty(spark)) == Counter()


def test_only_changed_rows_fail(spark):
    rows = [(k, "Upper" if k % 2 else "lower", "en", "s") for k in range(200)]
    for (i, own, sub, root, _, folded), _ in found(documents(spark, rows)).items():
        assert (folded == root) is not (i % 2 == 1 and zlib.crc32(str(i).encode()) % 3 == 0)


def test_query_against_sql(spark):
    from tests.oracle import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), queries.QUERIES["op11_merkle_manifest"], queries.ORACLES["op11_merkle_manifest"], sf) is None
