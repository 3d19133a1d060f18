"""What a replay handles: every call, but only the lists that are asked for, and nothing twice."""

import pytest
from pyspark.sql import functions as F

from dialogprep.catalog import all_queries
from dialogprep.operators import lists, order, store
from dialogprep.operators.calls import tool_calls

SMALL = "/root/testdata/sf0.001"
REPLIES = [
    (1, '<tool_call>add_memory(input_text=["a", "b"])</tool_call> <tool_call>delete_diary(indices=[2])</tool_call>'),
    (2, '<tool_call>add_reminder(subject="s \\" q", reminder_text=\'r\')</tool_call><tool_call>check_watch()</tool_call>'),
    (3, '<tool_call>add_diary(input_text=["x\\\\", \'y\', 3])</tool_call><tool_call>nonsense(1)</tool_call>'),
    (4, '<tool_call>add_memory(input_text=["open)</tool_call><tool_call>complete_reminder(indices=[1])</tool_call>'),
]


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that a replay writes, by label."""
    tables = {}

    def keep(module):
        write = module.durable

        def durable(df, label="step"):
            out = write(df, label)
            tables.setdefault(label, []).append(out)
            return out

        monkeypatch.setattr(module, "durable", durable)

    for module in (store, lists, order):
        keep(module)
    return tables


@pytest.mark.parametrize("kinds", [("memory",), ("diary",), ("reminder",), ("memory", "reminder")])
def test_calls_of_some_tools_are_those_of_all_calls(spark, kinds):
    df = spark.createDataFrame(REPLIES, "op_id long, content string")
    tools = store.tools_of(*kinds)
    some = sorted(map(repr, tool_calls(df, tools=tools).collect()))
    assert some == sorted(map(repr, tool_calls(df).filter(F.col("tool").isin(*tools)).collect())) != []


@pytest.mark.parametrize("name,kind", [
    ("reminder_stamps", "reminder"), ("complete_reminder", "reminder"), ("batch_delete_diary", "diary"), ("batch_delete_memory", "memory"),
])
def test_lists_of_other_kinds_are_not_replayed(spark, written, name, kind):
    assert all_queries()[name](spark, SMALL).count() > 0
    assert [r.kind for t in written["ops"] for r in t.select("kind").distinct().collect()] == [kind]


def test_calls_without_a_list_only_pass_by(spark, written):
    rows = all_queries()["replay_outcomes"](spark, SMALL)
    assert rows.filter("tool = 'check_watch' and message is not null").count() > 0
    assert written["ops"][0].filter("tool = 'check_watch'").count() > 0
    for label in ("ordered", "resolved"):
        for t in written[label]:
            assert "tool" not in t.columns or t.filter("tool = 'check_watch'").isEmpty()
    assert len(written["shared"]) == 1
