import re
from collections import Counter

import corpus_pipeline
from dialogprep.llm import mixing, pieces, quality, secrets
from tests.llm.cases import documents
from tests.llm.test_simhash import fingerprint, groups


def corpus(spark):
    import random

    r = random.Random(1)
    vary = lambda n: " ".join("".join(r.choice("abcdefghijkl") for _ in range(5)) for _ in range(n))
    clean = [(k, f"{vary(120).capitalize()}.\n{vary(60).capitalize()}.", "en", f"s{k % 2}") for k in range(20)]
    words = clean[0][1].split(" ")
    near = (50, " ".join([*words[:-1], "other"]), "en", "s0")
    long = (60, ".\n".join(vary(90).capitalize() for _ in range(60)) + ".", "en", "s1")
    leak = (51, f'{vary(80).capitalize()}. The token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is here.', "en", "s1")
    junk = (52, " | ".join(vary(1) for _ in range(200)), "en", "s0")
    return documents(spark, [*clean, near, leak, junk, long, long, clean[7], (53, clean[3][1], "en", "s1"), (54, None, "en", "s1"), (55, "short", None, None)], clash=["row", "content", "size", "_row"])


def test_stages(spark):
    docs = corpus(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, None).collect(), stage(spark, docs, None).schema)
        seen[name] = docs.collect()
    rules, near, secret, mix, coded = (seen[n] for n in names)
    assert sorted(r.doc_id for r in rules) == sorted([*range(20), 7, 50, 51, 53, 60, 60])
    # brute force of the groups of fingerprints: the near copy goes, and so do the exact ones
    root = groups({r.doc_id: fingerprint(r.text, 4) for r in rules}, 4)
    assert sorted(r.doc_id for r in near) == sorted(set(root.values())) == [*range(20), 51, 60]
    assert [r.text for r in secret if r.doc_id == 51][0].count("[assign]") == 1
    assert {r.doc_id: r.text for r in near if r.doc_id != 51} == {r.doc_id: r.text for r in secret if r.doc_id != 51}
    # brute force of the mix: half as much again, by weight, whole copies
    sizes = Counter()
    for r in secret:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    taken = Counter()
    for r in mix:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    goals = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    longest = max(len(r.text.split()) for r in secret)
    assert all(goals[s] - 1 <= taken[s] <= goals[s] + longest for s in sizes)
    model = pieces.load(spark, corpus_pipeline.PIECES)
    import numpy as np

    by_id = {r.doc_id: r.text for r in secret}
    assert len(coded) == len(mix) and all(pieces.decode(model, np.array(r.ids, np.int32)) == by_id[r.doc_id] for r in coded)
    assert quality and secrets


def test_run_on_given_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "ids"] and out.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark):
    from tests.llm.cases import empty

    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)
