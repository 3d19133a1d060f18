import pytest
from pyspark.sql import functions as F

from dialogprep.llm import licences
from tests.llm.cases import documents, empty, texts


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark)


def families(spark, model, rows, **options):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    return {r.doc_id: [(x.paragraph, x.family) for x in r.licences] for r in licences.scanned(docs, model=model, **options).collect()}


def test_held_out_accuracy(spark, model):
    table = licences.labelled(spark).filter("fold = 0").withColumnRenamed("paragraph", "text")
    got = licences.scanned(table, model=model).collect()
    right = [(r.licences[0].family if r.licences else licences.UNKNOWN) == r.family for r in got]
    assert len(right) > 60 and sum(right) / len(right) > 0.9


def test_notices_in_other_words(spark, model):
    rows = [
        "Some text.\nThis work is licensed under the GNU General Public License, version 3.\nMore text.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0.", "(c) 2019 A. Author\r\nSPDX-License-Identifier: BSD-3-Clause", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0, see below",
    ]
    got = families(spark, model, rows)
    assert [f for k in sorted(got) for _, f in got[k]] == ["gpl", "cc-by-nc", "mit", "apache-2.0", "bsd", "cc-by", "cc-by-sa"]
    assert got[0] == [(1, "gpl")] and got[4] == [(1, "bsd")]


def test_prose_about_licences_is_unknown(spark, model):
    rows = ["He lost his fishing licence near the public house.", "The general met the public in version three of the play.", "Permission to land was granted free of charge to the pilot.", "mit der Bahn", "", None]
    assert all(v == [] for v in families(spark, model, rows).values())


def test_model_is_sparse_and_calibrated(spark, model):
    assert len(model["vocabulary"]) < 600 and 0.2 < model["temperature"] < 8
    anchored = set(licences.anchors())
    assert all(anchored & set(g.split()) for g in model["vocabulary"])
    m = licences._model_columns(model)
    bare = spark.range(1).select(licences._logits(F.array().cast("array<string>"), m).alias("z"), m["classes"].alias("c")).first()
    assert bare.c[bare.z.index(max(bare.z))] == licences.UNKNOWN  # a text without features


def test_over_tables(spark, model):
    rows = texts() + [(70, "Released under the MIT License.", "en", "s")] * 2
    got = licences.scanned(documents(spark, rows, clash=["licences", "n_paragraphs", "_any"]), model=model).collect()
    assert len(got) == len(rows)
    assert [[x.family for x in r.licences] for r in got if r.doc_id == 70] == [["mit"], ["mit"]]
    assert all(r.licences == [] for r in got if r.doc_id != 70)
    assert licences.scanned(empty(spark), model=model).count() == 0
    plan = licences.scanned(documents(spark), model=model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
