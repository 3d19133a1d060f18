"""JSON and text layouts of conversation corpora.

Two layouts occur. ``lines`` has one record per line (an object, or an array of messages,
with or without a trailing comma) and is read in splits, so one file may be of any size.
``document`` is a whole JSON value in one file and is read a file per task. Both keep the
order of the records.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.session import broadcast_small, durable

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"

# File names of the public corpora and the labels they are reported under.
CORPUS_FILES = {
    "dailydialog.json": "DailyDialog",
    "empathetic_dialogues.json": "EmpatheticDialogues",
    "personachat.json": "PersonaChat",
    "topical_chat.json": "TopicalChat",
}

MAX_BROADCAST_SPLITS = 200_000

METADATA = (
    "struct<dataset_name:string,version:string,created_by:string,description:string,"
    "tags:array<string>,license:string,num_examples:bigint>"
)


def _text(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return spark.read.text(path, wholetext=layout == "document").select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")
    )


def _named_text(spark: SparkSession, folder: str, names: Iterable[str], layout: str) -> DataFrame:
    """Text of those of the named files, or folders of part files, that exist; ``_name`` tells which."""
    names = sorted(set(names))
    try:
        text = _text(spark, f"{folder}/{{{','.join(names)}}}", layout)
    except AnalysisException:  # none exists
        text = spark.createDataFrame([], "value string, _path string, _start long")
    known = "|".join(re.escape(n) for n in names)
    return text.withColumn("_name", F.regexp_extract("_path", rf"/({known})(?:/[^/]*)?$", 1))


def _records(lines: DataFrame, layout: str) -> DataFrame:
    """Raw JSON text of each record, in order inside its split.

    A line holds a record, or an array of records; lines with only a bracket are skipped.
    """
    value = F.regexp_replace("value", r"^[\s\uFEFF]+|[\s,]+$", "")
    many = F.from_json(value, "array<string>")
    if layout == "document":
        records = F.when(F.startswith(value, F.lit("[")), many)
    else:
        records = F.when(F.startswith(value, F.lit("[")), many).when(F.startswith(value, F.lit("{")), F.array(value))
    keep = [c for c in lines.columns if c != "value"]
    return lines.select(*keep, F.explode(records).alias("record"))


def _in_file_order(df: DataFrame, out: str = "seq", per: Sequence[str] = ()) -> DataFrame:
    """Number rows as they stand in the files, from 0 for each value of ``per``.

    Rows of one split are contiguous, so the row ids, once written, differ from the place in
    the split by a constant. Offsets have one row per split of the input.
    """
    written = durable(df.withColumn("_at", F.monotonically_increasing_id()), "read")
    split = [*per, "_path", "_start"]
    splits = written.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # numbers in names count as numbers: part-100000 comes after part-99999
    padded = F.regexp_replace("_path", r"(\d+)", "0" * 20 + "$1")
    natural = F.regexp_replace(padded, r"\d*(\d{20})(?!\d)", "$1")
    earlier = W.partitionBy(*per).orderBy(natural, "_start").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.select(*split, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_off"))
    return written.join(broadcast_small(offsets, MAX_BROADCAST_SPLITS), split).withColumn(out, F.col("_at") + F.col("_off")).drop(
        "_at", "_off", "_path", "_start"
    )


def read_message_log(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """A flat log of messages: ``(seq, role, content)`` in file order."""
    message = F.from_json("record", MESSAGE)
    rows = _records(_text(spark, path, layout), layout).select("_path", "_start", message.alias("m"))
    return _in_file_order(rows.select("_path", "_start", "m.role", "m.content"))


def read_monologues(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Each record's ``content`` as a conversation of one assistant message."""
    rows = _records(_text(spark, path, layout), layout).select(
        "_path", "_start", F.get_json_object("record", "$.content").alias("content")
    )
    return _in_file_order(rows, "item").select(
        F.col("item").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), "content"
    )


def read_corpora(spark: SparkSession, folder: str, files: dict[str, str] | None = None, layout: str = "document") -> DataFrame:
    """Corpora of one folder: ``(corpus, rank, item, n_msgs, messages)``, one row per conversation.

    Missing files, files that are not a JSON list and items without a list of conversations
    are left out. ``rank`` gives the order of the corpora, ``item`` the order inside one.
    """
    files = CORPUS_FILES if files is None else files
    rank = _lookup(F.col("_name"), {name: str(i) for i, name in enumerate(files)}).cast("int")
    listed = F.get_json_object("record", "$.conversations")
    rows = (
        _records(_named_text(spark, folder, files, layout), layout)
        .select("_path", "_start", _lookup(F.col("_name"), files).alias("corpus"), rank.alias("rank"), listed.alias("listed"))
        .filter(F.startswith("listed", F.lit("[")))
        .select("_path", "_start", "corpus", "rank", F.from_json("listed", MESSAGES).alias("messages"))
    )
    return _in_file_order(rows, "item", per=["corpus"]).select(
        "corpus", "rank", "item", F.size("messages").cast("long").alias("n_msgs"), "messages"
    )


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Files with one message array per line and a trailing comma: ``(item, messages)``."""
    value = F.regexp_replace("value", r",\s*$", "")
    rows = _text(spark, path, "lines").select("_path", "_start", F.from_json(value, MESSAGES).alias("messages"))
    return _in_file_order(rows.filter("messages is not null"), "item").select("item", "messages")


def read_dataset(spark: SparkSession, path: str, default_metadata: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Dataset documents: conversations ``(item, id, messages)`` and their metadata.

    A file counts only if it is an object with both ``metadata`` and ``conversations``.
    ``valid`` in the metadata tells; an invalid file gives the default metadata, no
    conversations, and stays as it is.
    """
    docs = _text(spark, path, "document").select(
        "_path", "_start", F.from_json("value", "struct<metadata:string,conversations:string>").alias("d")
    )
    valid = F.coalesce(F.col("d.metadata").isNotNull() & F.startswith(F.col("d.conversations"), F.lit("[")), F.lit(False))
    convs = F.from_json("d.conversations", f"array<struct<id:string,messages:{MESSAGES}>>")
    rows = docs.filter(valid).select("_path", "_start", F.explode(convs).alias("c")).select("_path", "_start", "c.id", "c.messages")
    conversations = _in_file_order(rows, "item").select("item", "id", "messages")
    defaults = dict(default_metadata or {})
    meta = F.from_json("d.metadata", METADATA)
    count = F.when(valid, F.coalesce(meta["num_examples"], F.size(convs).cast("long"))).otherwise(F.lit(0).cast("long"))
    fields = [
        F.when(valid, meta[name]).otherwise(F.lit(defaults.get(name)).cast("string")).alias(name)
        for name in ("dataset_name", "version", "created_by", "description", "license")
    ]
    no_tags = F.array(*[F.lit(t) for t in defaults.get("tags", [])]).cast("array<string>")
    tags = F.when(valid, meta["tags"]).otherwise(no_tags)
    return conversations, docs.select(*fields, tags.alias("tags"), count.alias("num_examples"), valid.alias("valid"))


def read_prompts(
    spark: SparkSession, folder: str, names: dict[str, str], fallback: dict[str, str] | None = None,
    append: dict[str, str] | None = None,
) -> DataFrame:
    """Prompt texts ``(name, text)``; a missing file gives an empty text.

    ``fallback`` maps a name to the name whose text it takes when its own is empty;
    ``append`` adds text to a prompt that is not empty.
    """
    files = _named_text(spark, folder, names.values(), "document").select("_name", "value")
    # a handful of names, one row each
    wanted = spark.createDataFrame(list(names.items()), "name string, _name string")
    loaded = wanted.join(files, "_name", "left").select("name", F.coalesce("value", F.lit("")).alias("text"))
    other = loaded.select(F.col("name").alias("_other"), F.col("text").alias("_other_text"))
    picked = (
        loaded.withColumn("_other", _lookup(F.col("name"), fallback or {}))
        .join(other, "_other", "left")
        .select("name", F.coalesce(F.nullif("text", F.lit("")), "_other_text", F.lit("")).alias("text"))
    )
    extra = F.coalesce(_lookup(F.col("name"), append or {}), F.lit(""))
    return picked.select("name", F.when(F.col("text") != "", F.concat("text", extra)).otherwise("").alias("text"))


def _lookup(name: Column, table: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in table.items():
        out = F.when(name == key, F.lit(value)).otherwise(out)
    return out
