"""All conversations together must equal the rounds played one by one."""

import json

from pyspark.sql import functions as F

from dialogprep.catalog import runs as players
from dialogprep.operators import runs
from dialogprep.plans.generate import Prompts, generate_conversations

MANTRA = "I am."


def test_rounds_are_independent_of_partitions_and_drop_failures(spark):
    seeds = spark.createDataFrame(
        [(i, 4 + 2 * (i % 2), "q" * i, f"<think>t</think> a{i}") for i in range(40)], "conv_id long, target long, prev_question string, prev_answer string"
    )
    clients = {"tester": players.tester, "assistant": players.assistant, "rewriter": players.rewriter}

    def play(df):
        made = generate_conversations(df, clients, Prompts("T", "U", "S", "R"), "robin", "Robin", MANTRA, "2024-01-01 00:00:00", wait_seconds=0)
        return sorted(map(tuple, made.messages.select("conv_id", "turn", "role", "content").collect())), made.entries

    rows, entries = play(seeds)
    assert play(seeds.repartition(7))[0] == rows
    by_conv = {}
    for conv, turn, role, content in rows:
        by_conv.setdefault(conv, []).append((turn, role, content))
    assert 0 < len(by_conv) <= 40
    for conv, messages in by_conv.items():
        assert [m[0] for m in messages] == [-1, *range(4 + 2 * (conv % 2))]
        assert messages[0][1:] == ("system", "S")
        assert [m[1] for m in messages[1:]] == ["user", "assistant"] * (len(messages) // 2)
        for _, role, content in messages[1:]:
            if role == "assistant":
                assert content.startswith(f"<think>\n<self>{MANTRA}</self>\n") and "Done, " in content
    # adds of a round come before the removals of a later one
    assert entries.filter("kind = 'memory'").count() > 0


def test_owners_have_stores_of_their_own_and_see_their_reminders(spark):
    """An owner's conversations open as in a run of that owner alone, and calls work on the owner's lists."""
    seeds = [(i, 2, f"q{i} " * (i + 1), "a", ("ann", "bob", None)[i % 3]) for i in range(18)]
    stamp = "2024-01-01 00:00:00"
    schema = "conv_id long, target long, prev_question string, prev_answer string, owner string"
    reminders = spark.createDataFrame(
        [("reminder", "ann", 1, None, "Tea", "Water it", None, None, None), ("reminder", "ann", 2, None, "Done", "Gone", None, None, None),
         ("reminder", "carl", 3, None, "Other", "Not shown", None, None, None)],
        "kind string, owner string, entry_id long, content string, subject string, body string, created_at timestamp, last_checked_at timestamp, completed_at timestamp",
    ).withColumn("completed_at", F.when(F.col("subject") == "Done", F.lit(stamp).cast("timestamp")))
    clients = {"tester": players.tester, "assistant": players.assistant, "rewriter": players.rewriter}

    def play(rows):
        made = generate_conversations(
            spark.createDataFrame(rows, schema), clients, Prompts("T", "U", "S", "R"), "robin", "Robin", MANTRA, stamp, entries=reminders, wait_seconds=0)
        messages = {(r.conv_id, r.turn): (r.role, r.content) for r in made.messages.collect()}
        return messages, made.entries.select("kind", "owner", "entry_id", "content", "subject", "last_checked_at").collect()

    said, entries = play(seeds)
    alone = play([r for r in seeds if r[4] == "ann"])[0]
    assert alone and {k: v for k, v in said.items() if seeds[k[0]][4] == "ann" and k[1] <= 0} == {k: v for k, v in alone.items() if k[1] <= 0}
    for conv in {c for c, _ in said}:
        own = seeds[conv][4]
        assert said[conv, -2 if own == "ann" else -1] == ("system", "S") and ((conv, -2) in said) == (own == "ann")
        if own == "ann":
            role, text = said[conv, -1]
            assert role == "system" and "1. Tea — Water it" in text and "Last checked: 2023-12-31T17:00:00-07:00" in text and "Gone" not in text and "Not shown" not in text
    by_subject = {r.subject: r for r in entries if r.kind == "reminder"}
    assert by_subject["Tea"].last_checked_at is not None and by_subject["Other"].last_checked_at is None and by_subject["Done"].last_checked_at is None
    owners = {r.owner for r in entries if r.kind == "memory"}
    assert owners <= {"ann", "bob", "robin"} and len(owners) > 1


def test_retries_then_gives_up(spark):
    def client():
        tries = {}

        def ask(text):
            tries[text] = tries.get(text, 0) + 1
            if text == "never" or tries[text] < 3:
                raise RuntimeError
            return f"{text} after {tries[text]}"

        return ask

    df = spark.createDataFrame([("a",), ("never",)], "prompt string")
    got = {r.prompt: r.response for r in runs.generate(df, client, wait_seconds=0).collect()}
    assert got == {"a": "a after 3", "never": ""}
    assert {r.response for r in runs.generate(df, client, retries=1, wait_seconds=0).collect()} == {""}


def test_report_points_by_count_and_by_time(spark):
    minutes = [1, 2, 50, 51, 90, 91, 92, 93, 94, 95, 96, 97, 140, 141, 142, 143, 144, 145, 146, 147, 148]
    df = spark.createDataFrame(list(enumerate(minutes)), "item long, m long").select(
        "item", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("m").cast("int"))).alias("finished_at")
    )
    due, last = [], 0
    for n, m in enumerate(minutes, 1):
        if n % 10 == 0 or m - last > 30:
            due.append(n)
            last = m
    got = runs.report_points(df, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert sorted(r.n for r in got.collect()) == due


def test_request_payload_shapes(spark):
    row = spark.range(1).select(
        F.to_json(runs.request_messages(F.lit("s"), F.lit("u"))).alias("a"), F.to_json(runs.request_messages(F.lit("s"), F.lit("u"), F.lit("r"), F.lit("t"))).alias("b")
    ).first()
    assert [m["role"] for m in json.loads(row.a)] == ["system", "user"]
    assert [m["content"] for m in json.loads(row.b)] == ["s", "u", "r", "t"]
