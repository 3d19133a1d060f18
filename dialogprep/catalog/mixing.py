"""Mixing, packing, examples and token rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialogprep.catalog.registry import query
from dialogprep.catalog.views import MESSAGE_LOG, MIX, SEED, sql, table, view
from dialogprep.config import ChatTemplate, Settings
from dialogprep.operators import examples, mix
from dialogprep.operators.shape import to_message_log
from dialogprep.plans import prepare
from dialogprep.session import durable

SIZE, PROMPT, EOS = 8, "Be kind.", 3
# as many blocks as there are conversations, so that the work grows with the tables
TARGET_SQL = "(select count(distinct conv_id) from conversations)"
MAX_LEN = 700  # short enough that most rows are cut


def _target(spark, sf) -> int:
    return table(spark, sf, "conversations").select("conv_id").distinct().count()


def _settings(spark, sf) -> Settings:
    return Settings(target_megachats=_target(spark, sf), mega_size=SIZE, seed=SEED, system_prompt=PROMPT, eos_id=EOS)


def _sources(spark, sf):
    return prepare.from_turns(view(spark, sf, MIX))


def _keys(spark, sf):
    return durable(mix.conversation_keys(view(spark, sf, MIX)), "keys")  # narrow; read by sizes and both samplers


def _quota(spark, sf, keys):
    return mix.mix_quota(mix.source_sizes(keys), _target(spark, sf), SIZE)


def _pool(spark, sf):
    return mix.sample_pool(_keys(spark, sf), _target(spark, sf), SIZE, SEED)


def _packed(spark, sf):
    return mix.cap(mix.pack(mix.shuffle(_pool(spark, sf), SEED), SIZE), _target(spark, sf))


def _flat(spark, sf):
    return prepare.build_megachats(_sources(spark, sf), _settings(spark, sf))


# ---- the same steps in SQL ------------------------------------------------------------------


def steps(mix_sql: str, target: str = TARGET_SQL, size: int = SIZE, prompt: str = PROMPT) -> str:
    return f"""with mix as ({mix_sql}),
 keys as (select source, conv_key, count(*) as n_msgs from mix group by all),
 sizes as (select source, count(*) as n_source from keys group by source),
 weights as (select *, case when exists (select 1 from sizes where source = 'external')
     then case source when 'generated' then 0.2::double when 'external' then 0.7::double else 0.1::double end
     else case source when 'generated' then 0.9::double when 'external' then 0::double else 0.1::double end end as weight from sizes),
 quota as (select *, floor(({target} * {size})::double * weight)::bigint as quota from weights),
 placed as (select k.*, q.n_source, q.quota,
     row_number() over (partition by source order by md5('{SEED}|' || source || '|' || conv_key), conv_key) - 1 as slot
   from keys k join quota q using (source)),
 few as (select source, conv_key, n_msgs, slot as draw from placed where quota <= n_source and slot < quota),
 draws as (select source, n_source, unnest(range(quota)) as draw from quota where quota > n_source),
 many as (select p.source, p.conv_key, p.n_msgs, d.draw
   from (select *, ('0x' || substr(md5('{SEED}|' || source || '|' || draw), 1, 15))::bigint % n_source as slot from draws) d
   join placed p on p.source = d.source and p.slot = d.slot),
 pool as (select * from few union all select * from many),
 shuffled as (select *, row_number() over (order by md5('{SEED}|' || source || '|' || draw), source, draw) - 1 as pos from pool),
 packed as (select *, pos // {size} as mega_id from shuffled where pos // {size} < {target}),
 bare as (select mega_id, pos, turn, role, content, row_number() over (partition by mega_id order by pos, m.turn) - 1 as ord
   from packed p join mix m using (source, conv_key)),
 flat as (select mega_id, ord + 1 as ord, role, content from bare
   union all select distinct mega_id, 0, 'system', '{prompt}' from bare)
"""


_T = ChatTemplate()
_RENDER = f"'{_T.before_role}' || role || chr(10) || content || '{_T.after_content.strip()}' || chr(10)"
_GENERATION = f"'{_T.generation.strip()}' || chr(10)"

STEPS = steps(sql(MIX))
_EXAMPLES = """, examples as (select mega_id, ord, content as reply,
   count(*) filter (role = 'assistant') over w - 1 as example_no, ord + 1 as n_messages,
   (sum(length(content)) over w - length(content))::bigint as context_chars, role
 from flat window w as (partition by mega_id order by ord))
"""


def tokens(max_len: int, eos: int = EOS) -> str:
    """Ids as hex text: two digits an id."""
    return f""", coded as (select mega_id, ord, role, hex(encode({_RENDER})) as r, hex(encode(content)) || '{eos:02X}' as reply from flat),
 ctx as (select *, coalesce(string_agg(r, '') over (partition by mega_id order by ord rows between unbounded preceding and 1 preceding), '')
     || hex(encode({_GENERATION})) as prompt from coded),
 rows_ as (select mega_id, ord, (length(prompt) + length(reply)) // 2 as n_full, right(prompt || reply, {2 * max_len}) as ids,
   right(reply, {2 * max_len}) as tail from ctx where role = 'assistant')
"""


def _hex(ids):
    return examples.hex_digits(ids)


def _n_masked(labels):
    return (F.size(labels) - F.size(examples.unmasked(labels))).cast("long")


# ---- queries --------------------------------------------------------------------------------


@query(STEPS + "select source, n_source, weight from weights")
def mix_weights(spark, sf):
    return mix.mix_weights(mix.source_sizes(_keys(spark, sf)))


@query(STEPS + """select source, n_source, case source when 'generated' then 0.9::double when 'external' then 0::double else 0.1::double end as weight
from sizes where source <> 'external'""")
def mix_weights_without_external(spark, sf):
    return mix.mix_weights(mix.source_sizes(_keys(spark, sf).filter("source <> 'external'")))


@query(STEPS + "select source, n_source, weight, quota from quota")
def mix_quota(spark, sf):
    return _quota(spark, sf, _keys(spark, sf))


@query(STEPS + """select source, n_source, case source when 'generated' then 0::double when 'external' then 0.95::double else 0.05::double end as weight,
 case source when 'generated' then 0 when 'external' then 31920 else 1680 end::bigint as quota from sizes""")
def mix_quota_training_run(spark, sf):
    weights = {"generated": 0.0, "external": 0.95, "personality": 0.05}
    return mix.mix_quota(mix.source_sizes(_keys(spark, sf)), 4200, 8, weights)


@query(STEPS + "select * from few")
def sample_exact(spark, sf):
    keys = _keys(spark, sf)
    return mix.sample_exact(keys, _quota(spark, sf, keys), SEED)


@query(STEPS + "select * from many")
def oversample(spark, sf):
    keys = _keys(spark, sf)
    return mix.oversample(keys, _quota(spark, sf, keys), SEED)


@query(STEPS + "select * from pool")
def build_pool(spark, sf):
    return _pool(spark, sf)


@query(STEPS + "select * from shuffled")
def shuffle_pool(spark, sf):
    return mix.shuffle(_pool(spark, sf), SEED)


@query(STEPS + "select *, pos // 8 as mega_id from shuffled")
def pack_megachats(spark, sf):
    return mix.pack(mix.shuffle(_pool(spark, sf), SEED), SIZE)


@query(steps(sql(MIX)).replace(f"where pos // 8 < {TARGET_SQL}", "") + f""", z as (select * replace (case when (pos // 8) % 5 = 1 then 0 else n_msgs end as n_msgs) from packed),
 k as (select mega_id, row_number() over (order by mega_id) - 1 as n from z group by mega_id having sum(n_msgs) > 0)
select z.source, z.conv_key, z.n_msgs, z.draw, z.pos, k.n as mega_id from z join k using (mega_id) where k.n < {TARGET_SQL} // 2""")
def cap_megachats(spark, sf):
    pool = mix.shuffle(_pool(spark, sf), SEED)
    packed = mix.pack(pool, SIZE).withColumn("n_msgs", F.expr("case when mega_id % 5 = 1 then 0L else n_msgs end"))
    return mix.cap(packed, _target(spark, sf) // 2)


@query(STEPS + "select mega_id, ord, pos, content, role from bare")
def flatten_block(spark, sf):
    flat = mix.flatten_block(_packed(spark, sf), _sources(spark, sf).messages)
    return flat.select("mega_id", "ord", "pos", "role", "content")


@query(STEPS + "select * from flat")
def with_system(spark, sf):
    flat = mix.flatten_block(_packed(spark, sf), _sources(spark, sf).messages)
    return mix.with_system(flat, PROMPT)


@query(STEPS + _EXAMPLES + "select mega_id, ord, example_no, n_messages, context_chars, reply from examples where role = 'assistant'")
def prefix_examples(spark, sf):
    return examples.prefix_examples(_flat(spark, sf))


@query(STEPS + "select * from flat")
def build_megachats(spark, sf):
    return _flat(spark, sf)


@query(STEPS + f""", e as (select mega_id, ord, row_number() over (order by md5('{SEED}|' || mega_id || '|' || ord), mega_id, ord) - 1 as i,
  count(*) over () as n from flat where role = 'assistant')
select mega_id, ord, i < ceil(0.01::double * n) as is_test from e""")
def train_test_split(spark, sf):
    rows = _flat(spark, sf).filter("role = 'assistant'").select("mega_id", "ord")
    return examples.train_test_split(rows, 0.01, SEED)


@query(STEPS + f""", one as (select mega_id, ord from flat where role = 'assistant' order by md5('{SEED}|' || mega_id || '|' || ord), mega_id, ord limit 1)
select o.mega_id, o.ord, string_agg(chr(10) || '[' || upper(f.role) || ']:' || chr(10) || regexp_replace(f.content, '^\\s+|\\s+$', '', 'g'), chr(10) order by f.ord) as preview
from one o join flat f on f.mega_id = o.mega_id and f.ord <= o.ord group by o.mega_id, o.ord""")
def preview_example(spark, sf):
    flat = _flat(spark, sf)
    return examples.preview(examples.prefix_examples(flat), flat, SEED)


@query(STEPS + f"""select mega_id, string_agg({_RENDER}, '' order by ord) || {_GENERATION} as prompt from flat group by mega_id""")
def render_prompt(spark, sf):
    ordered = F.sort_array(F.collect_list(F.struct("ord", "role", "content")))
    return _flat(spark, sf).groupBy("mega_id").agg(examples.render_prompt(ordered, _T).alias("prompt"))


@query(STEPS + f"select mega_id, ord, hex(encode(content)) || '{EOS:02X}' as with_eos, hex(encode(content)) as without_eos from flat")
def encode_text(spark, sf):
    ids = examples.utf8_encoder(F.col("content"))
    return _flat(spark, sf).select(
        "mega_id", "ord", _hex(examples.with_eos(ids, EOS)).alias("with_eos"), _hex(examples.with_eos(ids, 0)).alias("without_eos")
    )


@query("""select doc_id, octet_length(encode(text)) as n_prompt, (-100 * octet_length(encode(text)))::bigint as masked_sum,
  hex(encode(source)) as reply from documents""")
def mask_labels(spark, sf):
    docs = table(spark, sf, "documents")
    labels = examples.mask_labels(examples.utf8_encoder(F.col("text")), examples.utf8_encoder(F.col("source")))
    masked = F.filter("labels", lambda l: l == -100)
    return docs.select("doc_id", labels.alias("labels")).select(
        "doc_id", F.size(masked).cast("long").alias("n_prompt"),
        F.aggregate(masked, F.lit(0).cast("long"), lambda a, l: a + l).alias("masked_sum"),
        _hex(F.filter("labels", lambda l: l != -100)).alias("reply"),
    )


@query("select doc_id, right(hex(encode(text)), 600) as ids from documents")
def truncate_left(spark, sf):
    ids = examples.utf8_encoder(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", _hex(examples.truncate_left(ids, 300)).alias("ids"))


def _encoded(spark, sf, max_len: int = MAX_LEN):
    return examples.encode_examples(_flat(spark, sf), _T, max_len, EOS)


@query(STEPS + tokens(MAX_LEN) + """select mega_id, ord, n_full, length(ids) // 2 as n_ids, ids, length(ids) // 2 - length(tail) // 2 as n_masked, tail
from rows_""")
def encode_examples(spark, sf):
    rows = _encoded(spark, sf)
    return rows.select(
        "mega_id", "ord", "n_full", F.size("input_ids").cast("long").alias("n_ids"), _hex(F.col("input_ids")).alias("ids"),
        _n_masked(F.col("labels")).alias("n_masked"), _hex(examples.unmasked(F.col("labels"))).alias("tail"),
    )


_LOG_MIX = f"""
with log as (select row_number() over (order by conv_id, turn) - 1 as seq, role, text as content from conversations),
 seg as (select *, coalesce(sum((role = 'assistant')::int) over (order by seq rows between unbounded preceding and 1 preceding), 0) as s from log)
select 'generated' as source, s::varchar as conv_key, seq as turn, role, content from seg
  where s < (select count(*) from log where role = 'assistant')
union all select 'external', conv_id::varchar, turn, role, text from conversations
union all select 'personality', doc_id::varchar, 0, 'assistant', text from documents"""


@query(steps(_LOG_MIX) + tokens(4096) + """select mega_id, ord, n_full, length(ids) // 2 as n_ids,
  length(ids) // 2 - length(tail) // 2 as n_masked, md5(ids) as ids_md5 from rows_""")
def prepare_dataset(spark, sf):
    log = to_message_log(view(spark, sf, MESSAGE_LOG))
    external = table(spark, sf, "conversations").select(
        F.lit("external").alias("source"), F.col("conv_id").cast("string").alias("conv_key"), "turn", "role", F.col("text").alias("content")
    )
    alone = table(spark, sf, "documents").select(
        F.col("doc_id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.col("text").alias("content")
    )
    sources = prepare.combine(prepare.from_message_log(log), prepare.from_turns(external), prepare.from_monologues(alone))
    rows = prepare.prepare_dataset(sources, _settings(spark, sf))
    return rows.select(
        "mega_id", "ord", "n_full", F.size("input_ids").cast("long").alias("n_ids"),
        _n_masked(F.col("labels")).alias("n_masked"),
        F.md5(_hex(F.col("input_ids"))).alias("ids_md5"),
    )


@query(STEPS + tokens(MAX_LEN) + """, n as (select *, row_number() over (order by mega_id, ord) - 1 as idx from rows_),
 b as (select *, idx // 16 as batch_id, max(length(ids)) over (partition by idx // 16) as w from n)
select batch_id, idx, ids || repeat('00', (w - length(ids)) // 2) as ids, w // 2 as width, length(ids) // 2 as n_real,
 (w - length(tail)) // 2 as n_ignored from b""")
def pad_batches(spark, sf):
    rows = examples.encode_batches(_flat(spark, sf), _T, MAX_LEN, 16, 0, EOS)
    return rows.select(
        "batch_id", "idx", _hex(F.col("input_ids")).alias("ids"), F.size("labels").cast("long").alias("width"),
        F.size(F.array_remove("attention_mask", 0)).cast("long").alias("n_real"), _n_masked(F.col("labels")).alias("n_ignored"),
    )


@query(STEPS + tokens(100_000) + "select e.mega_id, e.ord, f.content as supervised from rows_ e join flat f using (mega_id, ord)")
def supervised_tokens(spark, sf):
    rows = examples.supervised_text(_encoded(spark, sf, 100_000), special_ids=[EOS])
    return rows.select("mega_id", "ord", "supervised")
