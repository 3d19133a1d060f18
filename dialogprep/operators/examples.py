"""Training examples: one per assistant message, with everything before it as context.

Written out in full, the contexts of a block repeat each other and grow with the square of its
length. An example is therefore kept as a reference ``(mega_id, ord)`` into the block's
messages, and token ids are cut from shared sheets of the block's token stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.config import IGNORED_LABEL, ChatTemplate
from dialogprep.operators.order import BLOCK_ROWS, global_index, scan, seeded_hash
from dialogprep.operators.shape import is_role
from dialogprep.session import durable

Encoder = Callable[[Column], Column]

#: Tokens of a block that are put together at a time, unless rows are longer.
SHEET_TOKENS = 65_536


# ---- encoders -------------------------------------------------------------------------------


def utf8_encoder(c: Column) -> Column:
    """Byte values of the UTF-8 text; stays in the JVM."""
    return byte_ids(F.encode(c, "UTF-8"))


def byte_ids(data: Column) -> Column:
    # read as Latin-1, every byte is one character, and its code is the byte
    chars = F.split(F.decode(data, "ISO-8859-1"), "")
    return F.when(F.octet_length(data) == 0, F.array().cast("array<int>")).otherwise(F.transform(chars, lambda b: F.ascii(b)))


def hex_digits(ids: Column) -> Column:
    """Byte values as text, two digits each."""
    digits = F.array(*[F.lit(f"{b:02X}") for b in range(256)])
    return F.array_join(F.transform(ids, lambda i: F.get(digits, i)), "")


def utf8_decoder(ids: Column) -> Column:
    return F.decode(F.unhex(hex_digits(ids)), "UTF-8")


def python_encoder(encode: Callable[[str], Sequence[int]]) -> Encoder:
    """Any tokenizer's text-to-ids callable, run on Arrow batches."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [int(i) for i in encode(t)])

    return run


@dataclass(frozen=True)
class Parts:
    """The form in which encoded messages are written, exchanged, cut and joined until ids are needed.

    An array takes four bytes an id. Ids that are bytes stay the bytes they are.
    """

    pack: Encoder
    size: Callable[[Column], Column]
    cut: Callable[[Column, Column, Column], Column]  # a part, how much to leave out, how much to take
    join: Callable[[Column], Column]
    ids: Callable[[Column], Column]


def _joined_bytes(parts: Column) -> Column:
    # only strings are joined in one go; the cast neither checks nor changes bytes, so a part may end inside a character
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), "").cast("binary")


def parts_of(encoder: Encoder) -> Parts:
    if encoder is utf8_encoder:
        return Parts(
            lambda c: F.encode(c, "UTF-8"), F.octet_length, lambda p, skip, n: F.substring(p, (skip + 1).cast("int"), n.cast("int")),
            _joined_bytes, byte_ids,
        )
    return Parts(encoder, F.size, lambda p, skip, n: F.slice(p, (skip + 1).cast("int"), n.cast("int")), F.flatten, lambda p: p)


def _encoded_once(spark: SparkSession, encoder: Encoder, text: str) -> list[int]:
    """The ids of a fixed text."""
    if encoder is utf8_encoder:
        return list(text.encode())
    return list(spark.range(1).select(encoder(F.lit(text)).alias("ids")).first()["ids"])


# ---- prefix examples ------------------------------------------------------------------------


def render_message(template: ChatTemplate) -> Column:
    return F.concat(
        F.lit(template.before_role), F.col("role"), F.lit(template.after_role), F.col("content"),
        F.lit(template.after_content),
    )


def render_prompt(messages: Column, template: ChatTemplate) -> Column:
    """Chat text of an array of messages, ready for the assistant's turn."""
    parts = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(template.before_role), m["role"], F.lit(template.after_role), m["content"],
            F.lit(template.after_content),
        ),
    )
    return F.concat(F.array_join(parts, ""), F.lit(template.generation))


def prefix_examples(flat: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per assistant message: its place, the number of example in the block, the reply.

    The context of an example is the block's messages with a lower ``ord``; ``context_chars``
    is their total length.
    """
    reply = is_role("assistant")
    marked = scan(
        flat, ["mega_id"], "ord",
        before={"example_no": reply, "context_chars": F.length("content").cast("long")},
        block_rows=block_rows,
    )
    return marked.filter("role = 'assistant'").select(
        "mega_id", "example_no", "ord", (F.col("ord") + 1).alias("n_messages"), "context_chars",
        F.col("content").alias("reply"),
    )


def example_messages(examples: DataFrame, flat: DataFrame) -> DataFrame:
    """The stored messages of chosen examples, reply included, as one array per example.

    Meant for previews and other small choices of examples: the output repeats each context.
    """
    chosen = examples.select("mega_id", F.col("ord").alias("_upto"))
    return (
        chosen.join(flat, "mega_id")
        .filter(F.col("ord") <= F.col("_upto"))
        .groupBy("mega_id", F.col("_upto").alias("ord"))
        .agg(F.sort_array(F.collect_list(F.struct("ord", "role", "content"))).alias("_m"))
        .select("mega_id", "ord", F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    )


def train_test_split(examples: DataFrame, fraction: float, seed: int, keys: Sequence[str] = ("mega_id", "ord")) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(fraction * n)`` rows, chosen by seeded hash."""
    placed = global_index(examples, seed, list(keys), "_i")
    n = examples.agg(F.count(F.lit(1)).alias("_n"))
    size = F.ceil(F.lit(float(fraction)) * F.col("_n").cast("double"))
    # a one-row frame with the number of test rows
    return (
        placed.withColumn("_one", F.lit(1))
        .join(F.broadcast(n.select(size.alias("_size"), F.lit(1).alias("_one"))), "_one")
        .withColumn("is_test", F.col("_i") < F.col("_size"))
        .drop("_i", "_size", "_one")
    )


def preview(examples: DataFrame, flat: DataFrame, seed: int) -> DataFrame:
    """One seeded example as ``[ROLE]:`` text."""
    from dialogprep.functions.text import strip_ws

    chosen = (
        examples.select("mega_id", "ord", seeded_hash(seed, "mega_id", "ord").alias("_h"))
        .orderBy("_h", "mega_id", "ord").limit(1)
    )
    lines = F.transform(
        "messages", lambda m: F.concat(F.lit("\n["), F.upper(m["role"]), F.lit("]:\n"), strip_ws(m["content"]))
    )
    return example_messages(chosen, flat).select("mega_id", "ord", F.array_join(lines, "\n").alias("preview"))


def first_example(flat: DataFrame) -> DataFrame:
    """The messages of the first example in block order, reply included."""
    first = flat.filter("role = 'assistant'").agg(F.min(F.struct("mega_id", "ord")).alias("_f"))  # one row
    chosen = first.select(F.col("_f.mega_id").alias("mega_id"), F.col("_f.ord").alias("_upto"))
    return flat.join(F.broadcast(chosen), "mega_id").filter(F.col("ord") <= F.col("_upto")).drop("_upto")


# ---- token rows -----------------------------------------------------------------------------


def with_eos(ids: Column, eos_id: int | None) -> Column:
    """Append the end token. An id of 0 counts as unset, as does None."""
    return F.concat(ids, F.array(F.lit(int(eos_id)))) if eos_id else ids


def mask_labels(prompt: Column, reply: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(IGNORED_LABEL), F.size(prompt)), reply)


def truncate_left(ids: Column, max_len: int, size: Column | None = None) -> Column:
    """The last ``max_len`` elements. ``size`` spares counting an expensive ``ids``."""
    size = F.size(ids) if size is None else size
    return F.slice(ids, F.greatest(F.lit(1), size - max_len + 1), F.lit(max_len))


@dataclass(frozen=True)
class Layout:
    """How rows are made: their length, the ids around a reply, the form of parts, the tokens of a sheet."""

    width: int
    head: int  # bytes before the content of a reply
    opening: list[int]
    eos: list[int]
    parts: Parts
    sheet: int

    def base(self) -> Column:
        """The place of a sheet's first token: a sheet begins with what its rows see of the one before."""
        return F.greatest(F.lit(0).cast("long"), F.col("sheet") * self.sheet - self.width)

    def n_full(self) -> Column:
        return F.col("start") + F.col("n_reply") + (len(self.opening) + len(self.eos))


def layout_of(spark: SparkSession, template: ChatTemplate, max_seq_len: int, eos_id: int | None, encoder: Encoder) -> Layout:
    width, head = int(max_seq_len), f"{template.before_role}assistant{template.after_role}"
    opening = _encoded_once(spark, encoder, template.generation)
    return Layout(width, len(head.encode()), opening, [int(eos_id)] if eos_id else [], parts_of(encoder), max(SHEET_TOKENS, 2 * width))


def code_messages(flat: DataFrame, template: ChatTemplate, encoder: Encoder = utf8_encoder) -> DataFrame:
    """Messages ``(mega_id, ord, n, n_reply, part, reply)``, each encoded once and written.

    ``n_reply`` is null where there is no example. Bytes have no ``reply``, it is a stretch of the part.
    """
    parts = parts_of(encoder)
    content = F.when(F.col("role") == "assistant", F.col("content"))
    if encoder is utf8_encoder:
        coded = flat.select("mega_id", "ord", parts.pack(render_message(template)).alias("part"), F.octet_length(content).alias("n_reply"))
    else:
        reply = F.when(F.col("role") == "assistant", parts.pack(F.col("content")))
        coded = flat.select("mega_id", "ord", parts.pack(render_message(template)).alias("part"), reply.alias("reply"))
        coded = coded.withColumn("n_reply", F.when(F.col("reply").isNotNull(), F.size("reply")))
    coded = coded.withColumn("n", F.when(F.col("part").isNotNull(), parts.size(F.col("part"))).cast("long"))
    return durable(coded, "encoded", "zstd")  # the encoder runs once, not once per branch below


def place_messages(coded: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``start``, the place of a message in the token stream of its block, and ``example_no``."""
    before = {"start": F.col("n"), "example_no": F.col("n_reply").isNotNull().cast("long")}
    return scan(coded, ["mega_id"], "ord", before=before, block_rows=block_rows)


def make_sheets(coded: DataFrame, layout: Layout, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(mega_id, sheet, stream, examples)``: stretches of the token streams, and the examples that begin in them.

    A stream has what the examples of its sheet see after truncation: ``layout.sheet`` tokens and the
    ``layout.width`` before them. Parts are exchanged twice, to be placed and to meet on their sheets;
    only those near the end of a sheet go to the next one too.
    """
    parts, width = layout.parts, layout.width
    own = F.expr(f"start div {layout.sheet}")
    last = F.when(F.col("n") > 0, F.expr(f"(start + n - 1 + {width}) div {layout.sheet}")).otherwise(own)
    is_own = F.col("sheet") == own
    at = F.greatest(F.col("start"), layout.base())
    upto = F.least(F.col("start") + F.col("n"), (F.col("sheet") + 1) * layout.sheet)
    own_reply = [F.when(is_own, F.col(c)).alias(c) for c in ("n_reply", "reply") if c in coded.columns]
    met = (
        place_messages(coded, block_rows)
        .filter("n > 0 or n_reply is not null")
        .withColumn("sheet", F.explode(F.sequence(own, last)))
        .select(
            "mega_id", "sheet", "ord", "example_no", at.alias("start"), *own_reply,
            F.when(is_own, F.col("part")).otherwise(parts.cut(F.col("part"), at - F.col("start"), upto - at)).alias("part"),
        )
        .repartition("mega_id", "sheet")
    )
    # a row has the end of a long reply only
    kept = F.least(F.col("n_reply"), F.lit(max(0, width - len(layout.eos))))
    source, skip = ("reply", 0) if "reply" in coded.columns else ("part", layout.head)
    reply = parts.cut(F.col(source), F.col("n_reply") - kept + skip, kept)
    example = F.when(F.col("n_reply").isNotNull(), F.struct("example_no", "ord", "start", "n_reply", reply.alias("reply")))
    in_sheet = parts.cut(F.col("part"), F.lit(0), (F.col("sheet") + 1) * layout.sheet - F.col("start"))
    stretch = F.when(parts.size(F.col("part")) > 0, F.struct("start", in_sheet.alias("part")))
    grouped = met.groupBy("mega_id", "sheet").agg(
        F.sort_array(F.collect_list(stretch)).alias("_parts"), F.sort_array(F.collect_list(example)).alias("examples")
    )
    stream = parts.ids(parts.join(F.transform("_parts", lambda p: p["part"])))
    return grouped.filter(F.size("examples") > 0).select("mega_id", "sheet", stream.alias("stream"), "examples")


def cut_rows(sheets: DataFrame, layout: Layout) -> DataFrame:
    """The token rows of the examples of sheets, next to their other fields. Labels need no stream."""
    width, n_opening, n_eos = layout.width, len(layout.opening), len(layout.eos)
    fields = sheets.schema["examples"].dataType.elementType.names
    rows = sheets.select("mega_id", "sheet", "stream", F.explode("examples").alias("_e")).select("mega_id", "sheet", "stream", "_e.*")
    literal = lambda ids: F.array(*map(F.lit, ids)).cast("array<int>")
    rows = rows.withColumn("_reply_ids", F.concat(layout.parts.ids(F.col("reply")), literal(layout.eos)))
    n_reply = F.col("n_reply") + n_eos
    first = F.greatest(F.lit(0).cast("long"), F.col("start") - F.greatest(F.lit(0), width - n_opening - n_reply))
    n_context = (F.col("start") - first).cast("int")
    context = F.slice("stream", (first - layout.base() + 1).cast("int"), n_context)
    # a context is left only where the tail fits, so each part is cut by itself
    ids = F.concat(context, truncate_left(F.concat(literal(layout.opening), "_reply_ids"), width, n_opening + F.size("_reply_ids")))
    masked = F.array_repeat(F.lit(IGNORED_LABEL), F.least(n_context + n_opening, F.greatest(F.lit(0), width - n_reply)))
    more = [c for c in fields if c not in ("example_no", "start", "n_reply", "reply")]
    return rows.select("mega_id", *more, layout.n_full().alias("n_full"), ids.alias("input_ids"), F.concat(masked, "_reply_ids").alias("labels"))


def encode_examples(
    flat: DataFrame, template: ChatTemplate, max_seq_len: int, eos_id: int | None = None,
    encoder: Encoder = utf8_encoder, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(mega_id, ord, n_full, input_ids, labels)`` for each assistant message of each block.

    Work and output grow with examples times ``max_seq_len``, never with the square of a block,
    and no stream holds more than ``max_seq_len`` tokens above ``SHEET_TOKENS`` or two times ``max_seq_len``.
    """
    layout = layout_of(flat.sparkSession, template, max_seq_len, eos_id, encoder)
    return cut_rows(make_sheets(code_messages(flat, template, encoder), layout, block_rows), layout)


def number_examples(rows: DataFrame, out: str = "idx", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the 0-based place of each example in block order."""
    one = F.lit(1).cast("long")
    inside = scan(rows, ["mega_id"], "ord", before={"_k": one}, block_rows=block_rows)
    per_mega = rows.groupBy("mega_id").agg(F.count(F.lit(1)).alias("_m"))
    firsts = scan(per_mega, [], "mega_id", before={"_first": F.col("_m")}, block_rows=block_rows)
    return (
        inside.join(firsts.select("mega_id", "_first"), "mega_id")
        .withColumn(out, F.col("_first") + F.col("_k"))
        .drop("_k", "_first")
    )


def pad_batches(rows: DataFrame, batch_size: int, pad_id: int) -> DataFrame:
    """Pad each batch of ``batch_size`` consecutive examples to its longest one."""
    longest = F.max(F.size("input_ids")).over(W.partitionBy("batch_id"))
    return _padded(rows.withColumn("batch_id", F.expr(f"idx div {int(batch_size)}")).withColumn("_longest", longest), pad_id)


def _padded(rows: DataFrame, pad_id: int) -> DataFrame:
    short = F.col("_longest") - F.size("input_ids")
    return rows.select(
        "batch_id", "idx",
        F.concat("input_ids", F.array_repeat(F.lit(int(pad_id)), short)).alias("input_ids"),
        F.concat("labels", F.array_repeat(F.lit(IGNORED_LABEL), short)).alias("labels"),
        F.concat(F.array_repeat(F.lit(1), F.size("input_ids")), F.array_repeat(F.lit(0), short)).alias("attention_mask"),
    )


def encode_batches(
    flat: DataFrame, template: ChatTemplate, max_seq_len: int, batch_size: int, pad_id: int, eos_id: int | None = None,
    encoder: Encoder = utf8_encoder, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``pad_batches`` of the numbered rows of ``encode_examples``.

    The length of a row follows from the place of its example, so numbers, batches and widths are
    settled on narrow rows; the token rows are cut and padded last and are never exchanged.
    """
    layout = layout_of(flat.sparkSession, template, max_seq_len, eos_id, encoder)
    coded = code_messages(flat, template, encoder)
    sheet, n_ids = F.expr(f"start div {layout.sheet}"), F.least(layout.n_full(), F.lit(layout.width)).cast("int")
    placed = place_messages(coded.select("mega_id", "ord", "n", "n_reply"), block_rows).filter("n_reply is not null")
    numbered = number_examples(placed.select("mega_id", "ord", "example_no", sheet.alias("sheet"), n_ids.alias("n_ids")), block_rows=block_rows)
    numbered = numbered.withColumn("batch_id", F.expr(f"idx div {int(batch_size)}"))
    longest = F.max("n_ids").over(W.partitionBy("batch_id"))
    batches = numbered.select("mega_id", "sheet", "example_no", "idx", "batch_id", longest.alias("_longest"))
    # one row per sheet, beside the sheet's examples
    beside = batches.groupBy("mega_id", "sheet").agg(F.sort_array(F.collect_list(F.struct("example_no", "idx", "batch_id", "_longest"))).alias("_b"))
    sheets = make_sheets(coded, layout, block_rows)
    fields = sheets.schema["examples"].dataType.elementType.names
    both = F.zip_with(
        "examples", "_b", lambda e, b: F.struct(*[e[f].alias(f) for f in fields], *[b[f].alias(f) for f in ("idx", "batch_id", "_longest")])
    )
    sheets = sheets.join(beside.hint("shuffle_hash"), ["mega_id", "sheet"]).select("mega_id", "sheet", "stream", both.alias("examples"))
    return _padded(cut_rows(sheets, layout), pad_id)


def unmasked(labels: Column) -> Column:
    """The ids whose label is not masked; such a label is the id itself."""
    return F.array_remove(labels, IGNORED_LABEL)


def supervised_text(rows: DataFrame, special_ids: Sequence[int] = (), decoder: Encoder = utf8_decoder) -> DataFrame:
    """Add ``supervised``: the decoded tokens the loss sees, special tokens skipped."""
    ids = unmasked(F.col("labels"))
    for special in special_ids:
        ids = F.array_remove(ids, int(special))
    # the generator makes the array once, in compiled code; inside a decoder's lambda it would be interpreted
    return rows.select("*", F.explode(F.array(ids)).alias("_ids")).withColumn("supervised", decoder(F.col("_ids"))).drop("_ids")
