"""From sources to training rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.config import Settings
from dialogprep.operators import mix
from dialogprep.operators.examples import Encoder, encode_examples, example_messages, prefix_examples, utf8_encoder
from dialogprep.operators.order import BLOCK_ROWS, scan
from dialogprep.operators.shape import drop_open_segments, normalize_role, segment_at_reply
from dialogprep.session import durable


@dataclass(frozen=True)
class Sources:
    """Conversation keys ``(source, conv_key, n_msgs)`` and messages ``(source, conv_key, turn, role, content)``.

    ``turn`` is the dense 0-based place of a message in its conversation. A conversation
    without messages has a key and no message rows.
    """

    keys: DataFrame
    messages: DataFrame
    #: ``messages`` with a filter on whole conversations put where they are not yet exchanged
    early: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None

    def only(self, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return self.early(keep) if self.early else keep(self.messages)


def from_message_log(log: DataFrame, block_rows: int = BLOCK_ROWS) -> Sources:
    """Generated conversations out of a flat log ``(seq, role, content)``."""
    closed = drop_open_segments(segment_at_reply(normalize_role(log), (), "seq", block_rows))
    return from_turns(
        closed.select(F.lit("generated").alias("source"), F.col("seg").cast("string").alias("conv_key"), "seq", "role", "content"),
        "seq", block_rows,
    )


def from_turns(messages: DataFrame, pos: str = "turn", block_rows: int = BLOCK_ROWS) -> Sources:
    """Long-form conversations whose ``pos`` has gaps or does not start at 0."""
    one = F.lit(1).cast("long")

    def dense(keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        numbered = scan(keep(messages), mix.KEY, pos, before={"_turn": one}, block_rows=block_rows)
        return numbered.select(*mix.KEY, F.col("_turn").alias("turn"), "role", "content")

    return Sources(mix.conversation_keys(messages), dense(lambda df: df), dense)


def from_corpora(corpora: DataFrame) -> Sources:
    """External conversations as read from corpus files."""
    keyed = corpora.withColumn("source", F.lit("external")).withColumn(
        "conv_key", F.concat_ws("/", F.col("corpus"), F.col("item").cast("string"))
    )
    messages = keyed.select(*mix.KEY, F.posexplode("messages").alias("turn", "_m")).select(
        *mix.KEY, F.col("turn").cast("long").alias("turn"), "_m.role", "_m.content"
    )
    return Sources(keyed.select(*mix.KEY, "n_msgs"), messages)


def from_monologues(monologues: DataFrame) -> Sources:
    messages = monologues.select(
        F.lit("personality").alias("source"), F.col("conv_id").cast("string").alias("conv_key"), "turn", "role", "content"
    )
    return Sources(messages.select(*mix.KEY, F.lit(1).cast("long").alias("n_msgs")), messages)


def combine(*parts: Sources) -> Sources:
    def union(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    return Sources(union([p.keys for p in parts]), union([p.messages for p in parts]), lambda keep: union([p.only(keep) for p in parts]))


def build_megachats(sources: Sources, settings: Settings, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sampled, shuffled, packed and capped blocks: ``(mega_id, ord, role, content)``, system prompt first.

    The same seed gives the same blocks whatever the partitioning.
    """
    keys = durable(sources.keys, "keys")  # narrow; read by sizes, quotas and both samplers
    pool = durable(mix.sample_pool(keys, settings.target_megachats, settings.mega_size, settings.seed, settings.weights), "pool")
    packed = mix.cap(mix.pack(mix.shuffle(pool, settings.seed), settings.mega_size), settings.target_megachats, block_rows)
    # text is exchanged of drawn conversations alone
    messages = sources.only(mix.pool_filter(pool, settings.target_megachats * settings.mega_size))
    flat = mix.flatten_block(packed, messages, block_rows)
    return mix.with_system(flat, settings.system_prompt)


def prepare_dataset(
    sources: Sources, settings: Settings, encoder: Encoder = utf8_encoder, with_messages: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Training rows ``(mega_id, ord, n_full, input_ids, labels)``.

    ``(mega_id, ord)`` names the messages behind a row: those of the block up to ``ord``.
    ``with_messages`` adds them as a column, which repeats every context.
    """
    flat = build_megachats(sources, settings, block_rows)
    if with_messages:
        flat = durable(flat, "blocks")
    rows = encode_examples(flat, settings.template, settings.max_seq_len, settings.eos_id, encoder, block_rows)
    if with_messages:
        rows = rows.join(example_messages(prefix_examples(flat, block_rows), flat), ["mega_id", "ord"])
    return rows


def preflight(sources: Sources, settings: Settings, **options) -> DataFrame:
    """A two-block trial run of the whole preparation."""
    from dataclasses import replace

    return prepare_dataset(sources, replace(settings, target_megachats=2), **options)
