"""The distributed replay against a store that runs one call at a time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dialogprep.operators import store
from dialogprep.streaming.replay import all_outcomes, current_entries, replay_stream

START = dt.datetime(2024, 5, 1)
CALLS = (
    "user_id string, ts timestamp, op_id long, call_pos long, item_pos long, tool string, text_arg string, index_arg long, "
    "subject string, body string"
)


class Plain:
    def __init__(self):
        self.rows = {"memory": [], "diary": [], "reminder": []}
        self.last = dict.fromkeys(self.rows, 0)

    def open(self, kind, user):
        return [r for r in self.rows[kind] if (kind == "diary" or r["owner"] == user) and not r.get("done")]

    def run(self, user, ts, tool, text, index, subject, body):
        kind, op = store.TOOL_KIND[tool]
        live = self.open(kind, user)
        if op == "add":
            if kind == "reminder":
                if not subject.strip():
                    return False, "Reminder subject cannot be empty."
                if not body.strip():
                    return False, "Reminder text cannot be empty."
            self.last[kind] += 1
            content = f"{ts:%B %d, %Y}\n{text}" if kind == "diary" else text
            row = {"id": self.last[kind], "owner": "" if kind == "diary" else user, "content": content, "subject": subject and subject.strip()}
            self.rows[kind].append(row)
            says = {"memory": "Successfully added 1 memory.", "diary": "Successfully added 1 page.", "reminder": f"Reminder '{row['subject']}' added."}
            return True, says[kind]
        if op == "look":
            if kind == "reminder":
                for r in live:
                    r["checked"] = ts
            return None, live and [r["id"] for r in live]
        if not 1 <= index <= len(live):
            return False, f"{kind.capitalize()} index {index} does not exist."
        row = live[index - 1]
        if tool == "complete_reminder":
            row.update(done=ts, checked=ts)
            return True, f"Marked '{row['subject']}' as complete."
        self.rows[kind].remove(row)
        return True, f"Deleted reminder '{row['subject']}'." if kind == "reminder" else f"{kind.capitalize()} at index {index} deleted successfully."

    def entries(self):
        return sorted(
            (k, r["owner"], r["id"], r["content"], r["subject"], r.get("checked"), r.get("done")) for k, rs in self.rows.items() for r in rs
        )


def make_calls(rng, n, hot=0.5):
    out = []
    for i in range(n):
        user = "hot" if rng.random() < hot else f"u{rng.randint(0, 4)}"
        tool = rng.choices(list(store.TOOL_KIND), weights=[5, 1, 2, 5, 1, 2, 5, 1, 1, 1])[0]
        adds = tool.startswith("add")
        reminder = tool == "add_reminder"
        out.append((
            user, START + dt.timedelta(minutes=i // 3), i, 0, 0, tool, f"t{i}" if adds and not reminder else None,
            rng.randint(0, 6) if store.TOOL_KIND[tool][1] == "remove" else None,
            rng.choice([f" s{i}", " "]) if reminder else None, rng.choice([f"b{i} ", ""]) if reminder else None,
        ))
    return out


def plain(calls):
    it, said = Plain(), {}
    for user, ts, op_id, _, _, tool, text, index, subject, body in calls:
        said[op_id] = it.run(user, ts, tool, text, index, subject, body)
    return it, said


def entry_rows(df):
    rows = df.select("kind", "owner", "entry_id", "content", "subject", "last_checked_at", "completed_at").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[:3])


@pytest.mark.parametrize("fan,levels", [(2, 3), (2, 7), (8, 5)])
def test_stretches_cover_a_life_once(spark, fan, levels):
    lives = [(a, b) for a in range(0, 40, 3) for b in range(a + 1, 140, 7)]
    df = spark.createDataFrame(lives, "lo long, hi long")
    for r in df.select("lo", "hi", store._stretch_nodes(F.col("lo"), F.col("hi"), fan, levels).alias("s")).collect():
        covered = [n for level, node in r.s for n in range(node * fan**level, (node + 1) * fan**level)]
        assert sorted(covered) == list(range(r.lo, r.hi))
        assert all(sum(level == k for level, _ in r.s) <= 2 * (fan - 1) for k in range(levels - 1))


def test_recalls_make_the_rows_of_the_result_only(spark):
    """Many looks at many entries that are gone: what meets in the join is what was alive."""
    calls = []
    for k in range(300):
        calls.append(("u", START + dt.timedelta(seconds=3 * k), k, 0, 0, "add_memory", f"text {k}", None, None, None))
        calls.append(("u", START + dt.timedelta(seconds=3 * k + 1), k, 1, 0, "recall_memories", None, None, None, None))
        calls.append(("u", START + dt.timedelta(seconds=3 * k + 2), k, 2, 0, "delete_memory", None, 1 + k % 2, None, None))
    done = store.replay(spark.createDataFrame(calls, CALLS))
    plan = store.recall_rows(done)
    assert sorted(r.seq for r in plan.collect()) == sorted(r.seq for r in plan.select("seq", "entry_id").distinct().collect())
    alive, want = 0, 0
    for k in range(300):
        alive += 1
        want += alive
        alive -= alive >= 1 + k % 2
    assert plan.count() == want < 300 * 300 / 4
    joins = [n for n in plan._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in n and "level" in n]
    assert joins and all("<" not in n for n in joins)  # equal stretches alone decide, nothing is filtered afterwards


@pytest.mark.parametrize("block_rows", [8, 65_536])
def test_replay_matches_one_call_at_a_time(spark, block_rows):
    calls = make_calls(random.Random(5), 400)
    it, said = plain(calls)
    df = spark.createDataFrame(random.Random(6).sample(calls, len(calls)), CALLS)
    done = store.replay(df, block_rows=block_rows)
    assert entry_rows(done.entries) == sorted(it.entries(), key=lambda r: r[:3])
    for r in done.outcomes.collect():
        success, message = said[r.op_id]
        assert r.success == success
        if success is not None:
            assert r.message == message
        else:
            assert r.n_after == len(message or [])
    seen = {}
    rows = store.recall_rows(done).join(done.outcomes.select("seq", "op_id"), "seq").collect()
    for r in rows:
        seen.setdefault(r.op_id, []).append(r.entry_id)
    assert {k: sorted(v) for k, v in seen.items()} == {k: m for k, (s, m) in said.items() if s is None and m}


def test_replay_goes_on_from_a_state(spark):
    calls = make_calls(random.Random(9), 200)
    it, said = plain(calls)
    first = store.replay(spark.createDataFrame(calls[:120], CALLS))
    half = plain(calls[:120])[0]
    second = store.replay(spark.createDataFrame(calls[120:], CALLS), state=first.entries, start_ids=half.last, block_rows=16)
    assert entry_rows(second.entries) == sorted(it.entries(), key=lambda r: r[:3])
    for r in second.outcomes.filter("success is not null").collect():
        assert (r.success, r.message) == said[r.op_id]


def test_outcomes_and_entries_of_a_replay_shuffle_nothing_again(spark):
    calls = make_calls(random.Random(7), 60)
    done = store.replay(spark.createDataFrame(calls, CALLS))
    for df in (done.outcomes, done.entries, done.lifetimes):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("compact_every", [2, 50])
def test_stream_matches_batch_for_any_split(spark, tmp_path, compact_every):
    calls = make_calls(random.Random(3), 150)
    it, said = plain(calls)
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in (calls[:20], calls[20:23], calls[23:110], calls[110:]):
        spark.createDataFrame(part, CALLS).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(CALLS).parquet(inbox)
        replay_stream(stream, out, checkpoint, compact_every=compact_every).awaitTermination()
    assert entry_rows(current_entries(spark, out)) == sorted(it.entries(), key=lambda r: r[:3])
    got = {r.op_id: (r.success, r.message) for r in all_outcomes(spark, out).filter("success is not null").collect()}
    assert got == {k: v for k, v in said.items() if v[0] is not None}


def test_batch_delete_counts_in_one_snapshot(spark):
    state = spark.createDataFrame(
        [("memory", "u", i, c, None, None, START, None, None) for i, c in enumerate("abc", 1)],
        "kind string, owner string, entry_id long, content string, subject string, body string, created_at timestamp, "
        "last_checked_at timestamp, completed_at timestamp",
    )
    ops = spark.createDataFrame([(1, "u", [1, 2])], "op_id long, owner string, indices array<long>")
    left, _, _ = store.batch_delete(ops, state, "memory")
    assert [r.content for r in left.collect()] == ["c"]
    ups = spark.createDataFrame(
        [(1, "u", [(1, "x"), (9, "y"), (1, "z")])], "op_id long, owner string, updates array<struct<index:int,content:string>>"
    )
    new, _, said = store.batch_update(ups, state, "memory")
    assert [r.content for r in new.orderBy("index").collect()] == ["z", "b", "c"]
    assert said.first().message.split("\n")[1] == "Memory index 9 does not exist."
    nobody = ops.withColumn("owner", F.lit("w"))
    assert store.batch_delete(nobody, state, "memory")[2].first().message == "No memories found to delete."
