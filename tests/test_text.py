"""Hand-worked cases, one per branch."""

import pytest
from pyspark.sql import functions as F

from dialogprep.functions import text, toolcalls
from dialogprep.functions.clock import watch_text
from dialogprep.operators.calls import tool_calls
from dialogprep.operators.shape import target_messages

MANTRA = "I am (here). I speak?"


def apply(spark, make, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.v for r in df.select("i", make(F.col("c")).alias("v")).orderBy("i").collect()]


def test_strip_thinking(spark):
    got = apply(spark, text.strip_thinking, ["<think>a</think> hi </think> z ", "<think>open only", None, "", " \n x  ", "plain"])
    assert got == ["hi </think> z", "open only", "", "", "x", "plain"]


def test_clean_visible(spark):
    got = apply(spark, lambda c: text.clean_visible(c, MANTRA), [
        "</think> <think>z</think>\n hi <think>k</think>", "<think>a<think>b</think>c", "<think> open", None,
        f"x <self> {MANTRA}\n</self> y<self>{MANTRA}</self>", "<self>other</self> a", "\n</think></think>\t<think>p\nq</think>rest ",
    ])
    assert got == ["hi <think>k</think>", "c", "open", "", "x  y", "<self>other</self> a", "rest"]


def test_clean_visible_on_many_leading_sections(spark):
    assert apply(spark, lambda c: text.clean_visible(c, MANTRA), ["<think>a</think> " * 3000 + "end"]) == ["end"]


def test_split_thinking(spark):
    got = apply(spark, text.split_thinking, ["pre <think> t </think> ans", "no tags ", "</think> x <think> y", "<think></think> a ", None])
    assert [tuple(g) for g in got] == [("t", "ans"), (None, "no tags"), (None, "</think> x <think> y"), ("", "a "), (None, "")]


@pytest.mark.parametrize("original,rewritten,want", [
    ("<think>old</think> hi", "new the user", f"<think>\n<self>{MANTRA}</self>\nnew Robin\n</think>\n\nhi"),
    ("<think>old</think> hi", "", f"<think>\n<self>{MANTRA}</self>\nold\n</think>\n\nhi"),
    ("<think> </think> hi", "new", f"<think>\n<self>{MANTRA}</self>\n{text.DEFAULT_THINKING}\n</think>\n\nhi"),
    (" hi ", None, f"<think>\n<self>{MANTRA}</self>\n{text.DEFAULT_THINKING}\n</think>\n\nhi"),
    ("<think>old</think> hi", "<think>a</think>The user", f"<think>\n<self>{MANTRA}</self>\nRobin\n</think>\n\nhi"),
])
def test_assemble_reply(spark, original, rewritten, want):
    df = spark.createDataFrame([(original, rewritten)], "o string, r string")
    assert df.select(text.assemble_reply(F.col("o"), F.col("r"), "Robin", MANTRA)).first()[0] == want


@pytest.mark.parametrize("original,rewritten,want", [
    ("a<think>x</think>b", "the user <THINK>y", "a<think>\nRobin y\n</think>b"),
    ("a<think>x</think>b<think>z</think>", "n", "a<think>\nn\n</think>b<think>z</think>"),
    ("a<think>x</think>b", "", "a<think>x</think>b"),
    ("a<think>x", "n", "a<think>x"),
])
def test_replace_thinking(spark, original, rewritten, want):
    df = spark.createDataFrame([(original, rewritten)], "o string, r string")
    assert df.select(text.replace_thinking(F.col("o"), F.col("r"), "Robin")).first()[0] == want


def test_extract_question(spark):
    got = apply(spark, text.extract_question, ["<think>q</think>\n\n ask? ", "<think>q</think> ask?", "x</think>\n\n", " plain "])
    assert got == ["ask?", "<think>q</think> ask?", "x</think>", "plain"]


def test_target_messages(spark):
    got = [r[0] for r in spark.range(2, 9).select("id", target_messages(F.col("id")).alias("t")).orderBy("id").select("t").collect()]
    assert got == [4, 4, 4, 4, 4, 6, 6]


def test_classify_is_a_substring_rule_unless_strict(spark):
    calls = ['add_diary(input_text=["add_memory later"])', "recall_memories()", "nothing()", "delete_reminder(indices=[1])"]
    assert apply(spark, toolcalls.classify_tool, calls) == ["add_memory", "recall_memories", None, "delete_reminder"]
    assert apply(spark, lambda c: toolcalls.classify_tool(c, True), calls) == ["add_diary", "recall_memories", None, "delete_reminder"]


def test_list_arg(spark):
    got = apply(spark, toolcalls.list_arg, [
        'add_memory(input_text=["a", "b"])', 'add_memory(input_text=["x]y"])', "add_memory(input_text=[])", "add_memory()",
        r"""add_memory(input_text = ['it\'s', "q"])""", r'add_memory(input_text=["a\nb\\n\"c\""])', "add_memory(input_text=[name])",
        'add_memory(input_text=["a" "b"', 'add_memory(input_text=["a",])', 'add_memory(input_text=["line\nbreak"])',
    ])
    assert got == ["a", None, None, None, "it's", 'a\nb\\n"c"', None, None, "a", None]


def test_index_arg(spark):
    got = apply(spark, toolcalls.index_arg, ["d(indices=[1,2])", "d(indices=[7])", "d(indices = [12])", "d(indices=[-1])", "d(indices=[])"])
    assert got == [None, 7, 12, None, None]


def test_string_arg(spark):
    calls = ['r(subject="s", reminder_text=\'b "q"\')', r'r(subject="a\"b")', "r(subject='x\ny')", "r(reminder_text=5)"]
    assert apply(spark, lambda c: toolcalls.string_arg(c, "subject"), calls) == ["s", None, None, None]
    assert apply(spark, lambda c: toolcalls.string_arg(c, "reminder_text"), calls) == ['b "q"', None, None, None]


def test_tool_calls_drop_invalid_and_keep_positions(spark):
    reply = (
        'x <tool_call>add_memory(input_text=["a", "b"])</tool_call><tool_call>delete_memory(indices=[1,2])</tool_call>'
        '<tool_call>add_reminder(subject="s")</tool_call>\n<tool_call>\ncheck_watch()\n</tool_call><tool_call>nope</tool_call>'
        '<tool_call>complete_reminder(indices=[3])</tool_call>'
    )
    df = spark.createDataFrame([(1, reply)], "op_id long, content string")
    got = [(r.call_pos, r.tool, r.text_arg, r.index_arg) for r in tool_calls(df).orderBy("call_pos").collect()]
    assert got == [(0, "add_memory", "a", None), (3, "check_watch", None, None), (5, "complete_reminder", None, 3)]
    every = [(r.call_pos, r.item_pos, r.text_arg) for r in tool_calls(df, first_only=False).orderBy("call_pos", "item_pos").collect()]
    assert every[:2] == [(0, 0, "a"), (0, 1, "b")]


def test_watch_text(spark):
    df = spark.createDataFrame([("2024-07-04 01:02:03",), ("2024-01-01 00:00:00.250000",)], "t string")
    got = [tuple(r.w) for r in df.select(watch_text(F.col("t").cast("timestamp")).alias("w")).collect()]
    assert got[0] == ("It's currently Wednesday, July 03, 2024 at 07:02 PM MDT (Bozeman time).", "2024-07-03T19:02:03-06:00")
    assert got[1] == ("It's currently Sunday, December 31, 2023 at 05:00 PM MST (Bozeman time).", "2023-12-31T17:00:00.250000-07:00")
