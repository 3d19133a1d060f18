"""A training corpus in five stages, each written as Parquet and read again by the next one.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``; the
last returns token ids. Stages work on the whole of what their predecessor kept.

Null and empty texts fail the quality rules and go there; a stage that is given them all the same
counts null as empty. Very long texts pass every stage whole. Of rows with equal ids and texts one
passes the near-duplicate stage, and of rows that share an id the one with the least text; rows
without an id stay. Equal training positions are ordered by id. Columns beyond those of ``documents``
pass through whatever their names, but that ``ids`` is replaced. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dialogprep.llm import mixing, pieces, quality, secrets, simhash
from dialogprep.llm.queries import PIECES
from dialogprep.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, and documents that the line rules or the base rules reject."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: four-word shingles, fingerprints of 64 bits that differ in four or fewer."""
    return simhash.first_of_each(docs, shingle=4, limit=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark that names their kind."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, in the order of training."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return pieces.encoded(docs, PIECES).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("piece encoding", encode),
]

#: The near-duplicate and encoding stages can't be said in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
