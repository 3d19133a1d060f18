import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dialogprep.operators import lists
from dialogprep.operators.lists import _nth_free, replay_lists, replay_rows


def brute(ops):
    lists, out = {}, {}
    for key, seq, op, index in sorted(ops, key=lambda o: o[1]):
        live = lists.setdefault(key, [])
        ok, target = True, None
        if op == "add":
            live.append(seq)
        elif op == "remove":
            ok = 1 <= index <= len(live)
            target = live.pop(index - 1) if ok else None
        out[seq] = (ok, target, len(live))
    return out


def make_log(rng, sizes, p_add, max_index):
    ops, seq = [], 0
    for key in sorted(sizes):
        for _ in range(sizes[key]):
            x = rng.random()
            if x < p_add:
                ops.append((key, seq, "add", None))
            elif x < 0.95:
                ops.append((key, seq, "remove", rng.randint(0, max_index)))
            else:
                ops.append((key, seq, "look", None))
            seq += 1
    return ops


def test_nth_free():
    taken = [2, 3, 7]
    assert [_nth_free(taken, n) for n in range(1, 6)] == [1, 4, 5, 6, 8]


@pytest.mark.parametrize("p_add,max_index,block_rows", [(0.6, 4, 7), (0.5, 30, 16), (0.45, 2, 5), (0.9, 200, 32), (0.55, 10, 100_000)])
def test_lists_match_a_step_by_step_run(spark, p_add, max_index, block_rows):
    ops = make_log(random.Random(block_rows), {"a": 3, "b": 40, "hot": 500, "x": 1, "y": 25, "z": 60}, p_add, max_index)
    shuffled = random.Random(2).sample(ops, len(ops))
    df = spark.createDataFrame(shuffled, "list_key string, seq long, op string, index long")
    got = {r.seq: (r.ok, r.target_seq, r.n_after) for r in replay_lists(df, block_rows).collect()}
    assert got == brute(ops)


@pytest.mark.parametrize("p_add,max_index,block_rows", [(0.6, 300, 7), (0.45, 6, 9)])
def test_long_lists_as_trees_of_summaries(spark, p_add, max_index, block_rows):
    ops = make_log(random.Random(block_rows), {"a": 3, "b": 40, "hot": 150, "warm": 60, "z": 20}, p_add, max_index)
    df = spark.createDataFrame(random.Random(3).sample(ops, len(ops)), "list_key string, seq long, op string, index long")
    got = {r.seq: (r.ok, r.target_seq, r.n_after) for r in replay_lists(df, block_rows, group_rows=5).collect()}
    assert got == brute(ops)


def test_a_list_of_a_thousand_blocks_with_scattered_removals(spark):
    ops = make_log(random.Random(11), {"hot": 16_000, "z": 9}, 0.6, 2_000)
    df = spark.createDataFrame(ops, "list_key string, seq long, op string, index long")
    got = {r.seq: (r.ok, r.target_seq, r.n_after) for r in replay_lists(df, 16, group_rows=500).collect()}
    assert got == brute(ops)


def test_a_block_of_many_small_lists_builds_no_frame_per_list(monkeypatch):
    n = 3_000
    ops = pd.DataFrame({
        "list_key": [f"k{i // 3}" for i in range(3 * n)], "seq": range(3 * n), "op": ["add", "remove", "remove"] * n,
        "index": 1, "n_start": 0,
    }).sample(frac=1, random_state=1)
    frames = []
    make = pd.DataFrame.__finalize__
    monkeypatch.setattr(pd.DataFrame, "__finalize__", lambda self, *a, **k: frames.append(1) or make(self, *a, **k))
    out = lists._resolve((0,), ops).sort_values("seq")
    assert out["ok"].tolist() == [True, True, False] * n and out["n_after"].tolist() == [1, 0, 0] * n
    assert out["hit_seq"].tolist()[1::3] == list(range(0, 3 * n, 3))
    assert lists._summarise((0,), ops)[["shift"]].to_numpy().sum() == 0
    assert len(frames) < 100


@pytest.mark.parametrize("block_rows", [8, 100_000])
def test_removals_and_entries_know_each_other(spark, block_rows):
    ops = make_log(random.Random(4), {"a": 3, "b": 30, "hot": 90}, 0.6, 5)
    df = spark.createDataFrame([(*o, f"t{o[1]}") for o in ops] + [(None, len(ops), "look", None, "loose")], "list_key string, seq long, op string, index long, text string")
    notes = df.filter("seq % 3 = 0").select("seq", F.concat(F.lit("n"), "seq").alias("note"))
    rows = {r.seq: r for r in replay_rows(df, notes, ["text"], ["text", "note"], block_rows).collect()}
    want = brute(ops)
    removed = {target: seq for seq, (_, target, _) in want.items() if target is not None}
    note = lambda seq: f"n{seq}" if seq % 3 == 0 else None
    assert removed and len(rows) == len(ops) + 1
    for seq, (ok, target, n_after) in want.items():
        r, by = rows[seq], removed.get(seq)
        assert (r.ok, r.target_seq, r.n_after, r.note) == (ok, target, n_after, note(seq))
        assert r.target_text == (None if target is None else f"t{target}")
        assert (r.gone_seq, r.gone_text, r.gone_note) == ((None, None, None) if by is None else (by, f"t{by}", note(by)))
    assert (rows[len(ops)].ok, rows[len(ops)].n_after, rows[len(ops)].text) == (None, None, "loose")
