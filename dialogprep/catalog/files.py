"""Sources and sinks, on files written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.catalog.registry import query
from dialogprep.catalog.views import MESSAGE_LOG, sql, table, view
from dialogprep.operators.shape import explode_conversations
from dialogprep.session import scratch_path
from dialogprep.sources import files, sinks

_LOG = sql(MESSAGE_LOG)


def _message_arrays(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "role", "content"))),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    return view(spark, sf, MESSAGE_LOG).groupBy("conv_id").agg(ordered.alias("messages"))


def _write_lines(df: DataFrame, line, path: str, *order: str) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(line.alias("value")).write.text(path)


@query(f"select row_number() over (order by conv_id, turn) - 1 as seq, role, content from ({_LOG})")
def read_message_log(spark, sf):
    path = scratch_path(spark, "log")
    _write_lines(view(spark, sf, MESSAGE_LOG), F.to_json(F.struct("role", "content")), path, "conv_id", "turn")
    return files.read_message_log(spark, path)


_CORPUS_ITEM = """
select case conv_id % 3 when 0 then 'DailyDialog' when 1 then 'PersonaChat' else 'TopicalChat' end as corpus,
  row_number() over (partition by conv_id % 3 order by conv_id) - 1 as item, conv_id
from (select distinct conv_id from conversations where conv_id % 10 not in (0, 5))"""


@query(f"select i.corpus, i.item, c.turn, c.role, c.text as content from ({_CORPUS_ITEM}) i join conversations c on c.conv_id = i.conv_id")
def read_corpora(spark, sf):
    folder = scratch_path(spark, "corpora")
    good = F.to_json(F.struct(F.col("messages").alias("conversations")))
    line = F.when(F.col("conv_id") % 10 == 0, F.lit('{"other": 1}')).when(
        F.col("conv_id") % 10 == 5, F.lit('{"conversations": "none"}')).otherwise(good)
    items = _message_arrays(spark, sf)
    for rest, name in enumerate(("dailydialog.json", "personachat.json", "topical_chat.json")):
        _write_lines(items.filter(F.col("conv_id") % 3 == rest), line, f"{folder}/{name}", "conv_id")
    return explode_conversations(files.read_corpora(spark, folder, layout="lines"), keep=("corpus", "item"))


@query("""select row_number() over (order by doc_id) - 1 as conv_id, 0::bigint as turn, 'assistant' as role, text as content
from documents""")
def read_monologues(spark, sf):
    path = scratch_path(spark, "monologues")
    _write_lines(table(spark, sf, "documents"), F.to_json(F.struct(F.col("text").alias("content"))), path, "doc_id")
    return files.read_monologues(spark, path, layout="lines")


def _write_documents(spark, sf) -> str:
    path = scratch_path(spark, "dataset")
    meta = F.struct(
        F.lit("talk").alias("dataset_name"), F.lit("1.0").alias("version"), F.lit("tests").alias("created_by"),
        F.lit("a sample").alias("description"), F.array(F.lit("a"), F.lit("b")).alias("tags"), F.lit("MIT").alias("license"),
    )
    items = _message_arrays(spark, sf).select(
        F.expr("conv_id div 50").alias("shard"), F.struct(F.format_string("conv_%06d", "conv_id").alias("id"), "messages").alias("c")
    )
    docs = items.groupBy("shard").agg(F.collect_list("c").alias("conversations"))  # at most 50 conversations a file
    text = F.to_json(F.struct(meta.alias("metadata"), F.col("conversations")))
    text = F.when(F.col("shard") % 5 == 4, F.lit('{"metadata": {}}')).otherwise(text)
    docs.select("shard", text.alias("value")).write.partitionBy("shard").text(path)
    return path


@query("""select format('conv_{:06d}', conv_id) as id, turn, role, text as content
from conversations where (conv_id // 50) % 5 <> 4""")
def read_dataset(spark, sf):
    conversations, _ = files.read_dataset(spark, _write_documents(spark, sf))
    return explode_conversations(conversations, keep=("id",))


@query("""select case when ok then 'talk' else 'new' end as dataset_name, case when ok then 'a,b' else 'x' end as tags,
  case when ok then n else 0 end as num_examples, ok as valid
from (select count(distinct conv_id) as n, (conv_id // 50) % 5 <> 4 as ok from conversations group by conv_id // 50, ok)""")
def read_dataset_metadata(spark, sf):
    _, meta = files.read_dataset(spark, _write_documents(spark, sf), {"dataset_name": "new", "tags": ["x"]})
    return meta.select("dataset_name", F.array_join("tags", ",").alias("tags"), "num_examples", "valid")


@query("""select i.item, c.turn, c.role, c.text as content from conversations c join (
  select conv_id, row_number() over (order by conv_id) - 1 as item from (select distinct conv_id from conversations)) i
on i.conv_id = c.conv_id""")
def read_fragments(spark, sf):
    path = scratch_path(spark, "fragments")
    _write_lines(_message_arrays(spark, sf), F.concat(F.to_json("messages"), F.lit(",")), path, "conv_id")
    return explode_conversations(files.read_fragments(spark, path), keep=("item",))


@query("""select 'p' || i as name, case when i = 25 then b else coalesce(t, '') end || case when i = 3 then 'TOOLS' else '' end as text
from (select i, case when n_name is not null then n_name || ': ' || n_regionkey || chr(10) end as t,
        max(case when n_nationkey = 7 then n_name || ': ' || n_regionkey || chr(10) end) over () as b
      from range(27) r(i) left join nation on n_nationkey = i)""")
def read_prompts(spark, sf):
    folder = scratch_path(spark, "prompts")
    text = F.concat_ws(": ", "n_name", F.col("n_regionkey").cast("string"))
    table(spark, sf, "nation").select("n_nationkey", text.alias("value")).write.partitionBy("n_nationkey").text(folder)
    names = {f"p{i}": f"n_nationkey={i}" for i in range(27)}
    return files.read_prompts(spark, folder, names, fallback={"p25": "p7"}, append={"p3": "TOOLS", "p26": "TOOLS"})


@query("""select conv_id, turn, role, text as content, count(distinct conv_id) over () as num_examples from conversations""")
def write_dataset(spark, sf):
    path = scratch_path(spark, "written")
    sinks.write_dataset(view(spark, sf, MESSAGE_LOG), path, {"dataset_name": "talk", "tags": ["a", "b"]}, key="conv_id")
    meta = spark.read.json(f"{path}/metadata").select("num_examples", F.lit(1).alias("_one"))  # one row
    back = spark.read.parquet(f"{path}/conversations").withColumn("_one", F.lit(1))
    return back.join(F.broadcast(meta), "_one").drop("_one")


@query(_LOG)
def append_conversations(spark, sf):
    path = scratch_path(spark, "appended")
    log = view(spark, sf, MESSAGE_LOG)
    sinks.append_conversations(log.filter("conv_id % 2 = 0"), path)
    sinks.append_conversations(log.filter("conv_id % 2 = 1"), path)
    return spark.read.schema(log.schema).json(path)


@query("select conv_id, count(*) as n_msgs from conversations group by conv_id")
def cached_dataset(spark, sf):
    path = scratch_path(spark, "cache")

    def build():
        return view(spark, sf, MESSAGE_LOG).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_msgs"))

    def must_not_run():
        raise AssertionError("the finished table should have been used")

    params = {"by": "conv_id"}
    sinks.cached(spark, path, build, params)
    return sinks.cached(spark, path, must_not_run, params)
