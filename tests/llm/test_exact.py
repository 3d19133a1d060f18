import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dialogprep.llm import exact, queries
from tests.llm.cases import documents, empty, texts


def plainly(rows):
    """``(id, sha, keep_id, size)`` of every row, by looking at all rows of a text."""
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t or "", []).append(i)
    out = Counter()
    for i, t, *_ in rows:
        ids = by_text[t or ""]
        out[i, hashlib.sha256((t or "").encode()).hexdigest(), max((k for k in ids if k is not None), default=None), len(ids)] += 1
    return out


ROWS = texts() + [(100 + k, "the same text", "en", "s0") for k in range(300)] + [(None, "the same text", "en", "s0"), (None, "alone", "en", None), (None, "alone", "en", None)]


def test_groups_equal_plain_grouping(spark):
    got = exact.groups_of(documents(spark, ROWS, clash=["digest", "salt", "content", "size"])).collect()
    assert Counter((r.id, r.digest.hex(), r.keep_id, r["size"]) for r in got) == plainly(ROWS)


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_texts_with_equal_digests_stay_apart(spark, salts):
    weak = lambda content: F.length(content) % 5
    got = exact.groups_of(documents(spark, ROWS), digest=weak, salts=salts).collect()
    want = Counter()
    for (i, _, keep, size), n in plainly(ROWS).items():
        want[i, keep, size] += n
    assert Counter((r.id, r.keep_id, r["size"]) for r in got) == want


def test_a_hot_text_meets_in_few_rows(spark):
    rows = exact._rows(documents(spark, [(k, "hot", "en", "s") for k in range(5000)]), "doc_id", "text", exact.as_is, exact.sha256, exact.SALTS)
    salted = rows.groupBy("digest", "salt", "content").count().collect()
    assert len(salted) == exact.SALTS and max(r["count"] for r in salted) < 5000 / exact.SALTS * 2
    assert exact._winners(rows).count() == 1


def test_kept_rows(spark):
    docs = documents(spark, ROWS, clash=["row", "id", "digest"])
    left = exact.kept_rows(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    want = Counter()
    for (i, _, keep, _), n in plainly(ROWS).items():
        want[i] += n * (keep is None or i == keep)
    assert ids == +want
    assert {r.text or "" for r in left.collect()} == {t or "" for _, t, *_ in ROWS}


def test_normalised_texts(spark):
    rows = [(1, "A b", "en", "s"), (2, "a B", "en", "s"), (3, "a  b", "en", "s")]
    got = exact.groups_of(documents(spark, rows), normalise=F.lower).collect()
    assert {r.id: (r.keep_id, r["size"]) for r in got} == {1: (2, 2), 2: (2, 2), 3: (3, 1)}


def test_empty_table(spark):
    assert exact.groups_of(empty(spark)).count() == 0 and exact.kept_rows(empty(spark)).count() == 0


def test_query_against_sql(spark):
    from tests.oracle import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), queries.QUERIES["op13_exact_dedup"], queries.ORACLES["op13_exact_dedup"], sf) is None
