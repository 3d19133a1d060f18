import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dialogprep.llm import divergence, queries
from tests.llm.cases import documents, empty, texts


def plainly(rows, least_docs, top=10):
    """The audit over whole count vectors, in plain integers."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts, having = defaultdict(Counter), defaultdict(Counter)
    for _, t, lang, source in rows:
        found = term.findall((t or "").translate(low))
        counts[lang or "", source or ""].update(found)
        having[lang or ""].update(set(found))
    out = []
    for lang in {v for v, _ in counts}:
        kept = [t for t, n in having[lang].items() if n >= least_docs]
        whole = Counter()
        for (v, _), c in counts.items():
            whole.update(c if v == lang else ())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
        p = {s: share(c) for (v, s), c in counts.items() if v == lang}
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        q = share(whole)
        for s in p:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -f, k + 1) for k, (f, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -f, k + 1) for k, (f, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in divergence.audited(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def many(seed, sources, words, docs):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}é" if k % 5 == 0 else f"{a}{b}" for k, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "KLMNOPQRST")][:words]
    rows = [(k, " ".join(r.choices(vocabulary, [1 / (1 + i) for i in range(words)], k=r.randint(0, 60))), r.choice(["en", "de", None]), f"s{r.randrange(sources)}") for k in range(docs)]
    return rows + [(9000, "", "xx", "alone"), (9001, None, "yy", "a"), (9002, "one", "yy", "b"), (9003, "q " * 500, "en", "ß")]


def test_runs():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 50):
        a, b = r.integers(1, 4, n) * 10**8, r.integers(1, 4, n) * 10**8
        one, two = divergence.runs_of(a), divergence.runs_of(b)
        assert np.repeat(one[1], np.diff(one[0], append=n)).tolist() == a.tolist()
        assert divergence.runs_apart(one, two, n) == sum((x - y) ** 2 // (x + y) for x, y in zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("block_terms,chunk", [(16_384, 32), (7, 3)])
def test_audit_equals_whole_vectors(spark, block_terms, chunk):
    rows = many(3, 8, 90, 400)
    docs = documents(spark, rows, clash=["term", "idx", "n", "place", "words"])
    assert found(docs, block_terms=block_terms, chunk=chunk) == plainly(rows, 10)


def test_odd_rows(spark):
    rows = texts()
    assert found(documents(spark, rows), least_docs=2) == plainly(rows, 2)
    assert found(documents(spark, rows), least_docs=1000) == plainly(rows, 1000)
    assert found(empty(spark)) == []


def test_query_against_sql(spark):
    from tests.oracle import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), queries.QUERIES["op12_source_divergence"], queries.ORACLES["op12_source_divergence"], sf) is None
