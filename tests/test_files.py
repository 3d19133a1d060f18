import json

from dialogprep.sources import files, sinks

CONVS = [[{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": f"a{i}\n\"x\""}] for i in range(3)]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_message_log_layouts_agree(spark, tmp_path):
    log = [m for c in CONVS for m in c]
    write(tmp_path / "doc" / "log.json", json.dumps(log, indent=2))
    write(tmp_path / "one" / "log.json", json.dumps(log))
    write(tmp_path / "lines" / "log.json", "[\n" + ",\n".join(json.dumps(m) for m in log) + "\n]\n")
    want = [(i, m["role"], m["content"]) for i, m in enumerate(log)]
    for folder, layout in (("doc", "document"), ("one", "lines"), ("lines", "lines")):
        got = files.read_message_log(spark, str(tmp_path / folder), layout).select("seq", "role", "content")
        assert sorted(map(tuple, got.collect())) == want


def test_a_log_in_many_splits_keeps_its_order(spark, tmp_path):
    write(tmp_path / "log.json", "".join(json.dumps({"role": "user", "content": f"m{i}"}) + "\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = files.read_message_log(spark, str(tmp_path / "log.json"))
        assert sorted((r.seq, r.content) for r in got.collect()) == [(i, f"m{i}") for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_corpora_skip_what_does_not_fit(spark, tmp_path):
    items = [{"conversations": CONVS[0]}, {"other": 1}, {"conversations": "no"}, {"conversations": []}, {"conversations": CONVS[1]}]
    write(tmp_path / "dailydialog.json", json.dumps(items))
    write(tmp_path / "personachat.json", json.dumps({"conversations": CONVS[2]}))
    write(tmp_path / "topical_chat.json", json.dumps([{"conversations": CONVS[2]}])[:-3])
    write(tmp_path / "unrelated.json", json.dumps(items))
    rows = files.read_corpora(spark, str(tmp_path)).orderBy("rank", "item").collect()
    assert [(r.corpus, r.item, r.n_msgs) for r in rows] == [("DailyDialog", 0, 2), ("DailyDialog", 1, 0), ("DailyDialog", 2, 2)]
    assert rows[0].messages[1].content == 'a0\n"x"'
    assert files.read_corpora(spark, str(tmp_path / "doc-none")).count() == 0


def test_dataset_documents(spark, tmp_path):
    meta = {"dataset_name": "d", "version": "1", "tags": ["t"]}
    write(tmp_path / "a" / "d.json", json.dumps({"metadata": meta, "conversations": [{"id": f"c{i}", "messages": c} for i, c in enumerate(CONVS)]}, indent=2))
    convs, info = files.read_dataset(spark, str(tmp_path / "a"))
    assert [(r.item, r.id, len(r.messages)) for r in convs.orderBy("item").collect()] == [(0, "c0", 2), (1, "c1", 2), (2, "c2", 2)]
    assert info.first().num_examples == 3 and info.first().valid
    for i, text in enumerate(("{not json", "[1]", '{"metadata": {}}')):
        write(tmp_path / f"bad{i}" / "d.json", text)
        convs, info = files.read_dataset(spark, str(tmp_path / f"bad{i}"), {"dataset_name": "fresh"})
        row = info.first()
        assert convs.count() == 0 and not row.valid and row.num_examples == 0 and row.dataset_name == "fresh"


def test_fragments(spark, tmp_path):
    write(tmp_path / "f.json", "".join(json.dumps(c) + ",\n" for c in CONVS))
    rows = files.read_fragments(spark, str(tmp_path / "f.json")).orderBy("item").collect()
    assert [r.messages[0].content for r in rows] == ["q0", "q1", "q2"]


def test_prompts(spark, tmp_path):
    write(tmp_path / "v1.txt", "one\n")
    write(tmp_path / "v2.txt", "")
    write(tmp_path / "sys.txt", "be kind")
    names = {"user": "v2.txt", "user_v1": "v1.txt", "system": "sys.txt", "rewriter": "none.txt"}
    rows = files.read_prompts(spark, str(tmp_path), names, fallback={"user": "user_v1"}, append={"system": " TOOLS", "rewriter": " TOOLS"})
    assert {r.name: r.text for r in rows.collect()} == {"user": "one\n", "user_v1": "one\n", "system": "be kind TOOLS", "rewriter": ""}


def test_cache_depends_on_the_parameters(spark, tmp_path):
    built = []

    def build(n):
        def run():
            built.append(n)
            return spark.range(n)
        return run

    path = str(tmp_path / "cache")
    counts = [sinks.cached(spark, path, build(n), {"n": n}, force).count() for n, force in ((3, False), (3, False), (5, False), (3, True))]
    assert counts == [3, 3, 5, 3] and built == [3, 5, 3]


def test_written_dataset_counts_its_conversations(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c")], "id long, turn long, role string, content string")
    sinks.write_dataset(df, str(tmp_path / "out"), {"dataset_name": "d", "tags": ["x"]})
    assert spark.read.json(str(tmp_path / "out" / "metadata")).first().num_examples == 2
    sinks.write_message_arrays(df, str(tmp_path / "nested"), ["id"])
    rows = spark.read.json(str(tmp_path / "nested")).orderBy("id").collect()
    assert [[m.content for m in r.conversations] for r in rows] == [["a", "b"], ["c"]]
