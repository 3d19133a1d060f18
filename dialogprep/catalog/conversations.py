"""Shapes of conversations and prompt texts built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialogprep.catalog.registry import query
from dialogprep.catalog.views import GENERATION_LOG, MARKED_REPLIES, MESSAGE_LOG, MIX, generation_log, sql, view
from dialogprep.operators import dialogue, shape

_LOG, _GEN, _MIX, _MARKED = sql(MESSAGE_LOG), sql(GENERATION_LOG), sql(MIX), sql(MARKED_REPLIES)

_SEGMENTS = """
select conv_id, turn, lower(role) as role, text as content,
  coalesce(sum((role = 'assistant')::int) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0)::bigint as seg,
  coalesce(sum((role = 'assistant')::int) over (partition by conv_id order by turn rows between current row and unbounded following), 0) > 0 as closed
from conversations"""


@query(f"select conv_id, turn, lower(upper(role)) as role from ({_LOG})")
def normalize_role(spark, sf):
    upper = view(spark, sf, MESSAGE_LOG).withColumn("role", F.upper("role"))
    return shape.normalize_role(upper).select("conv_id", "turn", "role")


@query(f"select conv_id, turn, role, seg, closed from ({_SEGMENTS})")
def segment_at_reply(spark, sf):
    return shape.segment_at_reply(view(spark, sf, MESSAGE_LOG)).select("conv_id", "turn", "role", "seg", "closed")


@query(f"select conv_id, turn, role, seg, content from ({_SEGMENTS}) where closed")
def drop_open_segments(spark, sf):
    return shape.drop_open_segments(shape.segment_at_reply(view(spark, sf, MESSAGE_LOG)))


@query("select row_number() over (order by conv_id, turn) - 1 as seq, role, text as content from conversations")
def to_message_log(spark, sf):
    return shape.to_message_log(view(spark, sf, MESSAGE_LOG))


@query(f"select source, count(distinct conv_key) as n_conversations, count(*) as n_messages from ({_MIX}) group by source")
def source_counts(spark, sf):
    return shape.source_counts(view(spark, sf, MIX))


@query("""select conv_id, case when d <= 6 then 4 else 6 end::bigint as target
from (select distinct conv_id, conv_id % 7 + 2 as d from conversations)""")
def target_messages(spark, sf):
    ids = view(spark, sf, MESSAGE_LOG).select("conv_id").distinct()
    return ids.select("conv_id", shape.target_messages(F.col("conv_id") % 7 + 2).alias("target"))


_COMPLETE = """
with m as (select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) as prev,
             row_number() over (partition by conv_id order by turn desc) as back from conversations),
  f as (select conv_id, count(*) filter (role <> 'system') as n_spoken,
          bool_and(case role when 'user' then coalesce(prev, 'system') <> 'user'
                             when 'assistant' then coalesce(prev, '') = 'user'
                             else coalesce(prev, 'system') = 'system' end
                   and (role <> 'user' or coalesce(prev, 'system') in ('system', 'assistant'))) as fine,
          max(case when back = 1 then role end) as last_role
        from m group by conv_id)
select conv_id, n_spoken from f where fine and last_role = 'assistant'"""


@query(_COMPLETE)
def complete_conversations(spark, sf):
    return shape.complete_conversations(view(spark, sf, MESSAGE_LOG))


@query(f"select * from ({_COMPLETE}) where n_spoken = case when conv_id % 7 + 2 <= 6 then 4 else 6 end")
def complete_at_target(spark, sf):
    return shape.complete_conversations(view(spark, sf, MESSAGE_LOG), shape.target_messages(F.col("conv_id") % 7 + 2))


def _previous(partition: str) -> str:
    return f"""
with ends as (select conv_id, max(case when b = 2 then text end) as q, max(case when b = 1 then text end) as a
  from (select *, row_number() over (partition by conv_id order by turn desc) as b from conversations) group by conv_id),
 log as ({_GEN})
select item, conv_id, worker_id, prev_question, prev_answer from (
  select l.item, l.conv_id, l.worker_id,
    case when lag(l.item) over w is null then 'None.' else coalesce(lag(e.q) over w, 'None.') end as prev_question,
    coalesce(lag(e.a) over w, 'None.') as prev_answer
  from log l join ends e on e.conv_id = l.conv_id window w as ({partition} order by l.item))"""


@query(_previous("partition by l.worker_id"))
def previous_context(spark, sf):
    out = shape.previous_context(generation_log(spark, sf), view(spark, sf, MESSAGE_LOG))
    return out.select("item", "conv_id", "worker_id", "prev_question", "prev_answer")


@query(_previous(""))
def previous_context_global(spark, sf):
    out = shape.previous_context(generation_log(spark, sf), view(spark, sf, MESSAGE_LOG), by=())
    return out.select("item", "conv_id", "worker_id", "prev_question", "prev_answer")


@query(f"select conv_id, format('conv_{{:06d}}', 41 + row_number() over (order by item)) as id from ({_GEN})")
def assign_ids(spark, sf):
    return shape.assign_ids(generation_log(spark, sf).select("item", "conv_id"), ["item"], start=41).select("conv_id", "id")


_VISIBLE = r"""regexp_replace(case when contains(content, '</think>') then substr(content, instr(content, '</think>') + 8)
  else replace(content, '<think>', '') end, '^\s+|\s+$', '', 'g')"""

_TRANSCRIPT = f"""
select conv_id, string_agg(line, chr(10) order by turn) as transcript from (
  select conv_id, turn, count(*) over (partition by conv_id) as c, row_number() over (partition by conv_id order by turn) as n,
    row_number() over (partition by conv_id order by turn)::varchar || '. ' ||
      case role when 'user' then 'Tester' when 'assistant' then 'Assistant' else upper(role[1]) || lower(role[2:]) end || ': ' ||
      case role when 'assistant' then {_VISIBLE} else content end as line
  from ({_MARKED}) where role <> 'system') where n > c - 12 group by conv_id"""

_QUESTIONS = f"""
select conv_id, string_agg('- ' || q, chr(10) order by turn) as asked from (
  select conv_id, turn, {_VISIBLE} as q, row_number() over (partition by conv_id order by turn desc) as b
  from ({_MARKED}) where role = 'user') where b <= 5 and q <> '' group by conv_id"""

_LAST = f"""
select c.conv_id, coalesce(max(a.v), '') as last_reply from (select distinct conv_id from conversations) c left join (
  select conv_id, {_VISIBLE} as v, row_number() over (partition by conv_id order by turn desc) as b
  from ({_MARKED}) where role = 'assistant') a on a.conv_id = c.conv_id and a.b = 1 group by c.conv_id"""


@query(_TRANSCRIPT)
def transcript(spark, sf):
    return dialogue.transcript(view(spark, sf, MARKED_REPLIES))


@query(_QUESTIONS)
def recent_questions(spark, sf):
    return dialogue.recent_questions(view(spark, sf, MARKED_REPLIES))


@query(_LAST)
def last_reply(spark, sf):
    return dialogue.last_reply(view(spark, sf, MARKED_REPLIES))


_W = dialogue.Wording()


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"""select item, {_lit('Base.' + _W.opening + _W.previous_question)} || prev_question || {_lit(_W.previous_answer)} ||
  {_VISIBLE.replace('content', 'prev_answer')} as prompt from ({_previous('partition by l.worker_id')})""")
def opening_prompt(spark, sf):
    context = shape.previous_context(generation_log(spark, sf), view(spark, sf, MESSAGE_LOG))
    return dialogue.opening_prompt(context, "Base.").select("item", "prompt")


@query(f"""select item, {_lit('Base.' + _W.short_previous_question)} || prev_question || {_lit(_W.short_previous_answer)} || prev_answer as prompt
from ({_previous('')})""")
def opening_prompt_short(spark, sf):
    context = shape.previous_context(generation_log(spark, sf), view(spark, sf, MESSAGE_LOG), by=())
    return dialogue.opening_prompt(context, "Base.", short=True).select("item", "prompt")


@query(f"""select l.conv_id, {_lit('Base.' + _W.followup + _W.excerpt)} || coalesce(t.transcript, '') ||
  case when coalesce(q.asked, '') <> '' then {_lit(_W.asked)} || q.asked else '' end ||
  {_lit(_W.latest)} || case when l.last_reply = '' then {_lit(_W.no_answer)} else l.last_reply end as prompt
from ({_LAST}) l left join ({_TRANSCRIPT}) t on t.conv_id = l.conv_id left join ({_QUESTIONS}) q on q.conv_id = l.conv_id""")
def followup_prompt(spark, sf):
    return dialogue.followup_prompt(view(spark, sf, MARKED_REPLIES), "Base.")
