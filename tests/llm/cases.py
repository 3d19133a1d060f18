"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

WORDS = "the sea and a hill of stone was old when rain fell on every road that led to town by night".split()


def prose(seed, n):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        sentence = [r.choice(WORDS) for _ in range(r.randint(4, 14))]
        out += [*sentence[:-1], sentence[-1] + "."]
    return " ".join(out[:n])


def texts():
    """Texts by id; some ids and texts are missing, some rows stand twice."""
    rows = [(i, "\n".join(prose(100 * i + k, 30) for k in range(1 + i % 4)), "en", f"s{i % 3}") for i in range(12)]
    rows += [(20, None, "en", "s0"), (21, "", "en", None), (22, " \n\t ", None, "s1"), (23, prose(7, 20_000), "en", "s2"), (None, prose(8, 60), "en", "s1")]
    rows += [(24, rows[3][1], "en", "s0"), rows[4], (5, prose(9, 80), "de", "s0"), (25, "naïve 😀 café\n" + prose(10, 40), "fr", "s1"), (26, "x", "en", "s2")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=None, clash=()):
    df = spark.createDataFrame(texts() if rows is None else rows, SCHEMA)
    for name in clash:
        df = df.withColumn(name, df["lang"])
    return df


def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
