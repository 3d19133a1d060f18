import math

import pytest
from pyspark.sql import functions as F

from dialogprep.config import ChatTemplate, Settings
from dialogprep.operators import examples, mix
from dialogprep.operators.shape import complete_conversations, drop_open_segments, segment_at_reply
from dialogprep.plans import prepare

T = ChatTemplate()


def conversations(spark, counts=(("generated", 30), ("external", 50), ("personality", 200))):
    rows = []
    for source, n in counts:
        for c in range(n):
            length = 1 if source == "personality" else 2 + (c % 3) * 2
            for t in range(length):
                role = "assistant" if t % 2 or source == "personality" else "user"
                rows.append((source, f"{source[0]}{c}", t, role, f"{source} {c}.{t} é" + "x" * (c % 13)))
    return prepare.from_turns(spark.createDataFrame(rows, "source string, conv_key string, turn long, role string, content string"))


@pytest.fixture(scope="module")
def sources(spark):
    return conversations(spark)


def test_pool_sizes_and_repeats(spark, sources):
    pool = mix.sample_pool(sources.keys, 20, 8, 1)
    n = {r.source: (r.n, r.d) for r in pool.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("conv_key").alias("d")).collect()}
    assert n["generated"][0] == 32 and n["external"][0] == 112 and n["personality"] == (16, 16)
    assert n["generated"][1] <= 30 and n["external"][1] <= 50


def test_weights_follow_the_rules(spark, sources):
    sizes = mix.source_sizes(sources.keys)
    quota = {r.source: r.quota for r in mix.mix_quota(sizes, 4200, 8, {"generated": 0.0, "external": 0.95}).collect()}
    assert quota == {"generated": 0, "external": 31920, "personality": int(33600 * 0.1)}
    assert {r.quota for r in mix.mix_quota(sizes.filter("source = 'generated'"), 100, 1, {"generated": 0.29}).collect()} == {int(100 * 0.29)}


def test_same_seed_same_blocks_whatever_the_partitions(spark, sources):
    settings = Settings(target_megachats=5, mega_size=8, system_prompt="S")
    rows = lambda s, c: sorted(map(tuple, prepare.build_megachats(s, c).collect()))
    again = prepare.Sources(sources.keys.repartition(11), sources.messages.repartition(3))
    assert rows(sources, settings) == rows(again, settings)
    other = Settings(target_megachats=5, mega_size=8, system_prompt="S", seed=1)
    assert rows(sources, settings) != rows(sources, other)


def test_block_count_is_capped(spark, sources):
    full = prepare.build_megachats(sources, Settings(target_megachats=3, mega_size=7, system_prompt="S"))
    assert full.select("mega_id").distinct().count() == min(3, math.ceil(21 / 7))


def naive_rows(flat, max_len, eos):
    """Encode the whole rendered context of every example."""
    out, by_mega = {}, {}
    for mega, ord_, role, content in sorted(flat):
        by_mega.setdefault(mega, []).append((ord_, role, content))
    for mega, messages in by_mega.items():
        text = ""
        for ord_, role, content in messages:
            if role == "assistant":
                prompt, reply = list((text + T.generation).encode()), list(content.encode()) + ([eos] if eos else [])
                out[mega, ord_] = ((prompt + reply)[-max_len:], ([-100] * len(prompt) + reply)[-max_len:], len(prompt) + len(reply))
            text += f"{T.before_role}{role}{T.after_role}{content}{T.after_content}"
    return out


@pytest.mark.parametrize("max_len,eos", [(5, 3), (37, None), (150, 0), (150, 3), (100_000, 3)])
def test_token_rows_equal_encoding_every_context_in_full(spark, sources, max_len, eos):
    flat = prepare.build_megachats(sources, Settings(target_megachats=4, mega_size=6, system_prompt="Sys"))
    got = examples.encode_examples(flat, T, max_len, eos, block_rows=4)
    have = {(r.mega_id, r.ord): (r.input_ids, r.labels, r.n_full) for r in got.collect()}
    assert have == naive_rows([tuple(r) for r in flat.select("mega_id", "ord", "role", "content").collect()], max_len, eos)


def test_python_encoder_gives_the_same_rows(spark, sources):
    flat = prepare.build_megachats(sources, Settings(target_megachats=2, mega_size=3, system_prompt="S"))
    encoder = examples.python_encoder(lambda t: list(t.encode()))
    rows = lambda e: sorted(map(str, examples.encode_examples(flat, T, 90, 3, e).collect()))
    assert rows(encoder) == rows(examples.utf8_encoder)


def test_messages_of_an_example_end_with_its_reply(spark, sources):
    settings = Settings(target_megachats=2, mega_size=3, system_prompt="S", max_seq_len=64)
    rows = prepare.prepare_dataset(sources, settings, with_messages=True).collect()
    assert rows and all(len(r.messages) == r.ord + 1 and r.messages[-1].role == "assistant" and r.messages[0].content == "S" for r in rows)


def test_one_long_conversation_in_small_blocks(spark):
    rows = [("hot", t, "assistant" if t % 5 == 4 else "user", f"m{t}") for t in range(333)] + [("b", t, "user", "x") for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, content string")
    for block in (10, 65_536):
        out = drop_open_segments(segment_at_reply(df, block_rows=block))
        assert sorted((r.conv_id, r.turn, r.seg) for r in out.collect()) == [("hot", t, t // 5) for t in range(330)]
    pairs = [("c", t, "assistant" if t % 2 else "user", "") for t in range(40)] + [("d", 0, "user", ""), ("d", 1, "user", "")]
    shaped = spark.createDataFrame(pairs, "conv_id string, turn long, role string, content string")
    assert [tuple(r) for r in complete_conversations(shaped, block_rows=7).collect()] == [("c", 40)]


def test_split_size_is_the_ceiling(spark, sources):
    flat = prepare.build_megachats(sources, Settings(target_megachats=4, mega_size=6, system_prompt="S"))
    rows = examples.train_test_split(flat.filter("role = 'assistant'").select("mega_id", "ord"), 0.01, 5).collect()
    assert sum(r.is_test for r in rows) == math.ceil(0.01 * len(rows))


def test_empty_conversations_count_in_the_pool_but_leave_no_block(spark):
    keys = spark.createDataFrame([("external", f"e{i}", 0 if i < 6 else 2) for i in range(8)], "source string, conv_key string, n_msgs long")
    messages = keys.filter("n_msgs > 0").select("source", "conv_key", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("turn")).select(
        "*", F.lit("assistant").alias("role"), F.lit("t").alias("content"))
    settings = Settings(target_megachats=8, mega_size=1, weights={"external": 1.0})
    flat = prepare.build_megachats(prepare.Sources(keys, messages), settings)
    assert [r[0] for r in flat.select("mega_id").distinct().orderBy("mega_id").collect()] == [0, 1]
    assert flat.count() == 2 * 3


def test_the_preview_encodes_the_first_example_only(spark, sources):
    flat = prepare.build_megachats(sources, Settings(target_megachats=4, mega_size=6, system_prompt="S"))
    first = examples.first_example(flat)
    assert first.select("mega_id").distinct().count() == 1 and first.filter("role = 'assistant'").count() == 1
    everything = examples.number_examples(examples.encode_examples(flat, T, 500, 3)).filter("idx = 0").drop("idx")
    assert examples.encode_examples(first, T, 500, 3).collect() == everything.collect()


def test_bytes_are_coded_without_regular_expressions(spark):
    texts = ["", "a", "\x00z", "é日本😀", "line\n", "  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i long, t string")
    ids = examples.utf8_encoder(F.col("t"))
    out = {r.i: r for r in df.select("i", ids.alias("ids"), examples.hex_digits(ids).alias("h"), examples.utf8_decoder(ids).alias("back")).collect()}
    for i, t in enumerate(texts):
        assert (out[i].ids, out[i].h, out[i].back) == (list(t.encode()), t.encode().hex().upper(), t)
    assert out[len(texts)].ids is None
    assert "regexp" not in df.select(ids.alias("x"))._jdf.queryExecution().optimizedPlan().toString()


def test_supervised_text_needs_no_context(spark, sources):
    flat = prepare.build_megachats(sources, Settings(target_megachats=3, mega_size=6, system_prompt="S"))
    rows = examples.supervised_text(examples.encode_examples(flat, T, 100_000, 3), special_ids=[3]).select("mega_id", "ord", "supervised")
    assert "stream" not in rows._jdf.queryExecution().optimizedPlan().toString()
    want = flat.filter("role = 'assistant'").select("mega_id", "ord", F.col("content").alias("supervised"))
    assert sorted(rows.collect()) == sorted(want.collect())


def test_batches_exchange_no_token_rows(spark, sources):
    flat = prepare.build_megachats(sources, Settings(target_megachats=4, mega_size=6, system_prompt="S"))
    for max_len in (40, 5_000):
        want = examples.pad_batches(examples.number_examples(examples.encode_examples(flat, T, max_len, 3)), 4, 0)
        got = examples.encode_batches(flat, T, max_len, 4, 0, 3, block_rows=4)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]  # what joins and windows handle
    assert "AS input_ids" in plan and "AS input_ids" not in below and "AS labels" not in below


def exchanged(df):
    """Runs ``df``; bytes of the rows that its exchanges wrote, before compression."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ReusedExchangeExec":
            return 0
        own = node.metrics().apply("dataSize").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def long_blocks(spark):
    rows = [(m, o, "assistant" if o % 2 else "user", f"{m}.{o} é" * 150) for m in range(12) for o in range(10)]
    return spark.createDataFrame(rows, "mega_id long, ord long, role string, content string").cache()


def test_a_message_is_exchanged_twice_as_bytes(spark, long_blocks):
    text = long_blocks.agg(F.sum(F.octet_length("content"))).first()[0]
    assert exchanged(examples.encode_examples(long_blocks, T, 700, 3)) < 3 * text


def test_batches_exchange_each_message_twice_as_bytes(spark, long_blocks):
    text = long_blocks.agg(F.sum(F.octet_length("content"))).first()[0]
    assert exchanged(examples.encode_batches(long_blocks, T, 700, 4, 0, 3)) < 3 * text


@pytest.mark.parametrize("max_len", [3, 700, 40_000])
def test_rows_that_begin_on_an_earlier_sheet(spark, max_len):
    rows = [(m, o, "assistant" if o % 3 else "user", f"{m}.{o} é日" * (9_000 if o == 4 else 70 * o + m)) for m in range(2) for o in range(40)]
    rows += [(7, 0, "assistant", ""), (7, 1, None, "x"), (7, 2, "assistant", None), (7, 3, "assistant", "y")]
    flat = spark.createDataFrame(rows, "mega_id long, ord long, role string, content string")
    whole = [r for r in rows if r[2] is not None and r[3] is not None]
    for encoder in (examples.utf8_encoder, examples.python_encoder(lambda t: list(t.encode()))):
        given = flat if encoder is examples.utf8_encoder else flat.dropna()  # a tokenizer is not asked for nulls
        have = {(r.mega_id, r.ord): (r.input_ids, r.labels, r.n_full) for r in examples.encode_examples(given, T, max_len, 3, encoder, block_rows=16).collect()}
        assert have == naive_rows(whole, max_len, 3)


def test_texts_of_conversations_that_are_not_drawn_are_not_exchanged(spark):
    rows = [("personality", f"p{c}", 0, "assistant", f"text {c} " * 200) for c in range(300)] + [("external", f"e{c}", t, "assistant", "x") for c in range(40) for t in (3, 5)]
    messages = spark.createDataFrame(rows, "source string, conv_key string, turn long, role string, content string").cache()
    sources = prepare.combine(prepare.from_turns(messages.filter("source = 'external'")), prepare.from_turns(messages.filter("source = 'personality'")))
    flat = prepare.build_megachats(sources, Settings(target_megachats=5, mega_size=8))
    drawn = flat.filter("length(content) > 9").count()
    assert drawn == 4 and exchanged(flat) < 100 * 2_000
    dense = prepare.Sources(sources.keys, sources.messages)
    assert sorted(flat.collect()) == sorted(prepare.build_megachats(dense, Settings(target_megachats=5, mega_size=8)).collect())


def test_the_pool_filter_keeps_every_drawn_conversation(spark):
    pool = spark.range(5_000).select(F.lit("s").alias("source"), F.concat(F.lit("k"), F.col("id") * 7).alias("conv_key"))
    messages = spark.range(35_000).select(F.lit("s").alias("source"), F.concat(F.lit("k"), F.col("id")).alias("conv_key"), F.col("id").alias("turn"))
    for at_most in (5_000, 1):  # the second one has too few bits
        kept = mix.pool_filter(pool, at_most)(messages)
        assert kept.columns == messages.columns and kept.join(pool, ["source", "conv_key"]).count() == 5_000
    assert mix.pool_filter(pool, 5_000)(messages).count() < 8_000


def test_prepared_rows_write_each_block_once(spark, sources, monkeypatch):
    written, write = [], prepare.durable

    def noted(df, label="step", *more):
        written.append(label)
        return write(df, label, *more)

    for module in (prepare, examples):
        monkeypatch.setattr(module, "durable", noted)
    settings = Settings(target_megachats=2, mega_size=3, system_prompt="S", max_seq_len=64)
    assert prepare.prepare_dataset(sources, settings).count()
    assert [x for x in written if x in ("blocks", "encoded")] == ["encoded"]


def test_draws_are_not_broadcast(spark, sources):
    keys = sources.keys.cache()
    drawn = mix.oversample(keys, mix.mix_quota(mix.source_sizes(keys), 20, 8), 1)
    assert drawn.count() == 32 + 112
    assert "BroadcastHashJoin [source" in (text := drawn._jdf.queryExecution().executedPlan().toString())  # of quotas
    assert not [line for line in text.splitlines() if "BroadcastHashJoin" in line and "slot" in line]
