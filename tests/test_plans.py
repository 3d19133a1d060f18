"""What the physical plans must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from dialogprep.catalog.views import MESSAGE_LOG, view
from dialogprep.operators import examples, mix, shape
from dialogprep.operators.order import global_index, scan

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_partition_inputs(text):
    """Names of the operators that read a single-partition exchange, with the columns they carry."""
    return re.findall(r"Exchange SinglePartition.*\n(.*)\n", text)


@pytest.fixture(scope="module")
def log(spark):
    return view(spark, SF, MESSAGE_LOG)


def test_only_block_totals_meet_in_one_partition(log):
    for df in (
        global_index(log.select("conv_id", "turn"), 1, ["conv_id", "turn"], "i"),
        scan(log, ["conv_id"], "turn", before={"n": F.lit(1).cast("long")}),
        scan(log.withColumn("p", F.col("conv_id") * 1000 + F.col("turn")), [], "p", before={"n": F.lit(1).cast("long")}),
        shape.segment_at_reply(log),
    ):
        for line in single_partition_inputs(plan(df)):
            assert "HashAggregate" in line, line
            assert "content" not in line


def test_no_cross_join_in_the_mixing_plan(log):
    keys = log.select(F.when(F.col("conv_id") % 2 == 0, "external").otherwise("generated").alias("source"), F.col("conv_id").cast("string").alias("conv_key")).distinct().withColumn("n_msgs", F.lit(2))
    text = plan(mix.cap(mix.pack(mix.shuffle(mix.sample_pool(keys, 4, 8, 1), 1), 8), 4))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_the_columns_in_use(log):
    text = plan(shape.complete_conversations(log))
    assert all("text" not in s for s in re.findall(r"ReadSchema: struct<(.*?)>", text))


def test_text_functions_stay_in_the_jvm(log):
    from dialogprep.functions.text import assemble_reply

    text = plan(log.select(assemble_reply(F.col("content"), F.lit("x"), "Robin", "I am.")))
    assert "Python" not in text and "Exchange" not in text


def test_token_rows_need_no_python(spark, log):
    from dialogprep.config import ChatTemplate

    flat = log.select(F.col("conv_id").alias("mega_id"), F.col("turn").alias("ord"), "role", "content")
    assert "Python" not in plan(examples.encode_examples(flat, ChatTemplate(), 64, 3))
