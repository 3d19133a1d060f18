"""Weighted mixing of conversation sources and packing into fixed-size blocks.

Everything up to the packed pool works on one narrow row per conversation,
``(source, conv_key, n_msgs)``. Message text joins in last, and only for conversations that
made it into the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.config import WEIGHT_FALLBACK, WEIGHTS_WITH_EXTERNAL, WEIGHTS_WITHOUT_EXTERNAL
from dialogprep.operators.order import BLOCK_ROWS, global_index, scan, seeded_hash, spread_range

KEY = ["source", "conv_key"]

_MAP_BITS = 32_768  # of one row of bitmap_construct_agg
_MOST_BITS = 1 << 27  # 16 MB in all


def conversation_keys(messages: DataFrame) -> DataFrame:
    """One row per conversation with its message count."""
    return messages.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_msgs"))


def source_sizes(keys: DataFrame) -> DataFrame:
    return keys.groupBy("source").agg(F.count(F.lit(1)).alias("n_source"))


def _weight(weights: dict[str, float], fallback: dict[str, float]) -> Column:
    """The caller's weight of a source, else the fallback; a source that neither names is an error."""
    out = F.raise_error(F.concat(F.lit("no weight for source "), F.coalesce("source", F.lit("null")))).cast("double")
    for source in {**fallback, **weights}:
        out = F.when(F.col("source") == source, F.lit(float(weights.get(source, fallback.get(source))))).otherwise(out)
    return out


def mix_weights(sizes: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``weight`` per source: the caller's, else a default that depends on external data.

    ``sizes`` has one row per source.
    """
    if weights is not None:
        return sizes.withColumn("weight", _weight(weights, WEIGHT_FALLBACK))
    external = F.max(F.when((F.col("source") == "external") & (F.col("n_source") > 0), 1)).over(W.partitionBy())
    return sizes.withColumn(
        "weight",
        F.when(external == 1, _weight(WEIGHTS_WITH_EXTERNAL, WEIGHT_FALLBACK)).otherwise(
            _weight(WEIGHTS_WITHOUT_EXTERNAL, WEIGHT_FALLBACK)
        ),
    )


def mix_quota(sizes: DataFrame, target_megachats: int, mega_size: int, weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``quota``: the truncated product of pool size and weight. Empty sources give nothing."""
    total = target_megachats * mega_size
    return mix_weights(sizes.filter(F.col("n_source") > 0), weights).withColumn(
        "quota", F.floor(F.lit(total).cast("double") * F.col("weight"))
    )


def _indexed(keys: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """Conversations with their seeded place inside the source, next to the source's quota."""
    placed = global_index(keys, seed, KEY, "slot", within=["source"])
    return placed.join(F.broadcast(quota.select("source", "n_source", "quota")), "source")  # one row per source that has a weight


def sample_exact(keys: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """Without replacement, exactly ``quota`` rows of each source that has at least that many."""
    return (
        _indexed(keys, quota, seed)
        .filter((F.col("quota") <= F.col("n_source")) & (F.col("slot") < F.col("quota")))
        .select(*KEY, "n_msgs", F.col("slot").alias("draw"))
    )


def oversample(keys: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """With replacement, exactly ``quota`` draws of each source that is smaller than its quota.

    Each draw is a row that hashes to a slot; draws and conversations meet in an equi-join on
    (source, slot), and slots are uniform, so no key is hot.
    """
    short = quota.filter("quota > n_source")
    draws = spread_range(short, ["source", "n_source"], "quota", "draw")
    digits = F.substring(seeded_hash(seed, "source", "draw"), 1, 15)
    slots = draws.withColumn("slot", F.conv(digits, 16, 10).cast("long") % F.col("n_source"))
    pool = _indexed(keys, short, seed).select(*KEY, "n_msgs", "slot")
    # Spark takes the draws for as few as the sources they are made from, and would broadcast them
    return slots.select("source", "slot", "draw").hint("merge").join(pool, ["source", "slot"]).select(*KEY, "n_msgs", "draw")


def build_pool(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union of the sampled sources; ``(source, draw)`` identifies a row."""
    pool = parts[0]
    for part in parts[1:]:
        pool = pool.unionByName(part)
    return pool


def sample_pool(keys: DataFrame, target_megachats: int, mega_size: int, seed: int, weights: dict[str, float] | None = None) -> DataFrame:
    quota = mix_quota(source_sizes(keys), target_megachats, mega_size, weights)
    return build_pool([sample_exact(keys, quota, seed), oversample(keys, quota, seed)])


def shuffle(pool: DataFrame, seed: int) -> DataFrame:
    """Add ``pos``, the place of each pool row in a seeded order."""
    return global_index(pool, seed, ["source", "draw"], "pos")


def pack(pool: DataFrame, mega_size: int) -> DataFrame:
    """Consecutive blocks of ``mega_size`` conversations; the last may be short."""
    return pool.withColumn("mega_id", F.expr(f"pos div {int(mega_size)}"))


def cap(packed: DataFrame, target_megachats: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop blocks without any message, number the others densely, keep the first ``target``."""
    blocks = packed.groupBy("mega_id").agg(F.sum("n_msgs").alias("_m"))
    empty = (F.col("_m") == 0).cast("long")
    kept = (
        scan(blocks, [], "mega_id", before={"_gap": empty}, block_rows=block_rows)
        .filter("_m > 0")
        .select("mega_id", (F.col("mega_id") - F.col("_gap")).alias("_new"))
        .filter(F.col("_new") < target_megachats)
    )
    return packed.join(kept, "mega_id").withColumn("mega_id", F.col("_new")).drop("_new")


def pool_filter(pool: DataFrame, at_most: int) -> Callable[[DataFrame], DataFrame]:
    """A filter on messages that keeps all those of the pool's conversations, and few others.

    Conversations are marked in a bitmap by hash, 16 to 32 bits for each of the ``at_most`` rows of
    the pool and 16 MB at most. What passes by chance finds no partner in the join that follows.
    """
    bits = min(max(_MAP_BITS, 1 << (16 * at_most).bit_length()), _MOST_BITS)
    place = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in KEY]), F.lit(bits))
    row, bit = F.expr(f"_at div {_MAP_BITS}"), F.expr(f"_at % {_MAP_BITS}")
    maps = pool.select(place.alias("_at")).groupBy(row.alias("_row")).agg(F.bitmap_construct_agg(bit).alias("_map"))
    byte = F.ascii(F.decode(F.substring("_map", F.expr(f"cast(_at % {_MAP_BITS} div 8 as int) + 1"), F.lit(1)), "ISO-8859-1"))

    def keep(messages: DataFrame) -> DataFrame:
        marked = messages.withColumn("_at", place).withColumn("_row", row).join(F.broadcast(maps), "_row")
        return marked.filter(F.getbit(byte.cast("long"), F.expr("cast(_at % 8 as int)")) == 1).select(*messages.columns)

    return keep


def block_offsets(packed: DataFrame) -> DataFrame:
    """Add ``first_ord``: messages that precede the conversation in its block.

    A block has at most ``mega_size`` conversations, so this window is bounded.
    """
    earlier = W.partitionBy("mega_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    return packed.withColumn("first_ord", F.coalesce(F.sum("n_msgs").over(earlier), F.lit(0)))


def flatten_block(packed: DataFrame, messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Messages of the packed conversations as ``(mega_id, ord, pos, turn, role, content)``.

    ``messages`` carries ``turn``, the dense place of a message in its conversation, so ``ord``
    is a sum and needs no window over message rows. The join runs on runs of ``block_rows``
    turns, so the messages of one long conversation spread over many tasks.
    """
    runs = F.sequence(F.lit(0).cast("long"), F.expr(f"(n_msgs - 1) div {block_rows}"))
    drawn = block_offsets(packed).filter("n_msgs > 0").select(
        *KEY, "mega_id", "pos", "first_ord", F.explode(runs).alias("_run")
    )
    return drawn.join(messages.withColumn("_run", F.expr(f"turn div {block_rows}")), [*KEY, "_run"]).select(
        "mega_id", (F.col("first_ord") + F.col("turn")).alias("ord"), "pos", "turn", "role", "content"
    )


def with_system(flat: DataFrame, prompt: str) -> DataFrame:
    """Put the system prompt in front of each block as message 0."""
    # Message 0 of a block brings the prompt along, so no second pass finds the block ids.
    prompt_row = F.struct(
        F.lit(0).cast("long").alias("ord"), F.lit("system").alias("role"), F.lit(prompt).alias("content")
    )
    own_row = F.struct((F.col("ord") + 1).alias("ord"), F.col("role").alias("role"), F.col("content").alias("content"))
    rows = F.when(F.col("ord") == 0, F.array(prompt_row, own_row)).otherwise(F.array(own_row))
    return flat.select("mega_id", F.explode(rows).alias("_m")).select("mega_id", "_m.ord", "_m.role", "_m.content")
