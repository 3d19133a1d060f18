"""Text operators on replies, and tool-call extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialogprep.catalog.registry import query
from dialogprep.catalog.views import MANTRA, MARKED_REPLIES, MESSAGE_LOG, NAME, TOOL_LOG, sql, view
from dialogprep.functions import text, toolcalls
from dialogprep.operators import calls
from dialogprep.operators.runs import request_messages

_M, _TOOLS, _LOG = sql(MARKED_REPLIES), sql(TOOL_LOG), sql(MESSAGE_LOG)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _visible(x: str = "content") -> str:
    return _strip(f"case when contains({x}, '</think>') then substr({x}, instr({x}, '</think>') + 8) else replace({x}, '<think>', '') end")


_CLEAN = _strip(r"regexp_replace(regexp_replace({x}, '(?s)^\s*((</think>|<think>.*?</think>|<think>)\s*)*', ''), '<self>\s*"
                + MANTRA.replace(".", "[.]") + r"\s*</self>', '', 'g')")


def _clean(x: str) -> str:
    return _CLEAN.replace("{x}", x)


def _replies(spark, sf):
    return view(spark, sf, MARKED_REPLIES)


def _each(spark, sf, **columns):
    return _replies(spark, sf).select("conv_id", "turn", *[c.alias(n) for n, c in columns.items()])


def _content():
    return F.col("content")

_BLOCK = f"'<think>' || chr(10) || '<self>{MANTRA}</self>' || chr(10) || "


@query(f"select conv_id, turn, {_visible()} as visible from ({_M})")
def strip_thinking(spark, sf):
    return _each(spark, sf, visible=text.strip_thinking(_content()))


@query(f"""select conv_id, turn, {_clean('c')} as visible
from (select *, content || '<self> {MANTRA}' || chr(10) || '</self> end ' as c from ({_M}))""")
def clean_visible(spark, sf):
    return _each(spark, sf, visible=text.clean_visible(F.concat(_content(), F.lit(f"<self> {MANTRA}\n</self> end ")), MANTRA))


@query(f"select conv_id, turn, {_BLOCK} content || chr(10) || '</think>' as block from ({_M})")
def thinking_block(spark, sf):
    return _each(spark, sf, block=text.thinking_block(_content(), MANTRA))


_SPLIT = f"""
select conv_id, turn, content, case when whole then {_strip('substr(rest, 1, e - 1)')} end as thinking,
  case when whole then regexp_replace(substr(rest, e + 8), '^\\s+', '') else {_strip('content')} end as answer
from (select *, instr(rest, '</think>') as e, s > 0 and instr(rest, '</think>') > 0 as whole
  from (select *, instr(content, '<think>') as s, substr(content, instr(content, '<think>') + 7) as rest from ({_M})))"""


@query(f"select conv_id, turn, thinking, answer from ({_SPLIT})")
def split_thinking(spark, sf):
    parts = text.split_thinking(_content())
    return _each(spark, sf, thinking=parts["thinking"], answer=parts["answer"])


_REWRITE = "case when turn % 4 = 1 then '' else 'Hm, the user asks </think>. The user waits, turn ' || turn end"


@query(f"""select conv_id, turn, {_BLOCK} case when coalesce(thinking, '') = '' then '{text.DEFAULT_THINKING}'
    when rw <> '' then {_visible("replace(replace(rw, 'the user', '" + NAME + "'), 'The user', '" + NAME + "')")} else thinking end
  || chr(10) || '</think>' || chr(10) || chr(10) || {_clean('answer')} as reply
from (select *, {_REWRITE} as rw from ({_SPLIT}))""")
def assemble_reply(spark, sf):
    return _each(spark, sf, reply=text.assemble_reply(_content(), F.expr(_REWRITE), NAME, MANTRA))


@query(f"select conv_id, turn, replace(replace(content, 'the user', '{NAME}'), 'The user', '{NAME}') as renamed from ({_M})")
def rename_user(spark, sf):
    return _each(spark, sf, renamed=text.rename_user(_content(), NAME))


@query(f"""select conv_id, turn, case when s > 0 and e > 0 and rw <> '' then substr(content, 1, s - 1) || '<think>' || chr(10) ||
   {_strip("regexp_replace(replace(replace(rw, 'the user', '" + NAME + "'), 'The user', '" + NAME + "'), '(?i)</?think>', '', 'g')")}
   || chr(10) || '</think>' || substr(rest, e + 8) else content end as reply
from (select *, instr(rest, '</think>') as e, {_REWRITE} as rw
  from (select *, instr(content, '<think>') as s, substr(content, instr(content, '<think>') + 7) as rest from ({_M})))""")
def replace_thinking(spark, sf):
    return _each(spark, sf, reply=text.replace_thinking(_content(), F.expr(_REWRITE), NAME))


@query(f"""select conv_id, turn, {_strip("coalesce(nullif(case when instr(content, m) > 0 then substr(content, instr(content, m) + 10) end, ''), content)")} as question
from (select *, '</think>' || chr(10) || chr(10) as m from ({_M}))""")
def extract_question(spark, sf):
    return _each(spark, sf, question=text.extract_question(_content()))


@query(f"select conv_id, turn, contains(content, '<think>') as has_thinking from ({_M})")
def has_thinking(spark, sf):
    return _each(spark, sf, has_thinking=text.has_thinking(_content()))


@query(f"select conv_id, turn, substr(content, 1, 80) || '...' as preview from ({_LOG})")
def preview_text(spark, sf):
    return view(spark, sf, MESSAGE_LOG).select("conv_id", "turn", text.preview_text(_content()).alias("preview"))


def _payload(*parts: tuple[str, str]) -> str:
    return " || chr(10) || ".join(f"'{role}: ' || {content}" for role, content in parts)


@query(f"""select conv_id, turn, {_payload(('system', "'S'"), ('user', 'content'))} as short,
 {_payload(('system', "'S'"), ('user', "'Q'"), ('assistant', 'content'), ('user', "'T' || turn"))} as long from ({_M})""")
def request_payload(spark, sf):
    def lines(messages):
        return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")

    tool = F.concat(F.lit("T"), F.col("turn").cast("string"))
    return _each(
        spark, sf, short=lines(request_messages(F.lit("S"), _content())), long=lines(request_messages(F.lit("S"), F.lit("Q"), _content(), tool))
    )


@query(f"select conv_id, turn, case when turn % 3 = 0 then content else content || chr(10) || 'and ' || turn end as reply from ({_M})")
def splice_continuation(spark, sf):
    more = F.expr("case when turn % 3 = 0 then '' else concat('and ', turn) end")
    return _each(spark, sf, reply=text.splice(_content(), more))


# ---- tool calls -----------------------------------------------------------------------------

_CALLS = f"""
select op_id, user_id, ts, pos - 1 as call_pos, calls[pos] as call
from (select *, regexp_extract_all(content, '(?s)<tool_call>(.*?)</tool_call>', 1) as calls from ({_TOOLS})),
  lateral (select unnest(range(1, len(calls) + 1)) as pos)"""
_TOOL = "case " + " ".join(f"when contains(call, '{t}') then '{t}'" for t in toolcalls.TOOLS) + " end"


def _tool_rows(spark, sf):
    rows = view(spark, sf, TOOL_LOG)
    return rows.select("op_id", F.posexplode(toolcalls.extract_tool_calls(_content())).alias("call_pos", "call")).withColumn(
        "call_pos", F.col("call_pos").cast("long")
    )


@query(f"select op_id, call_pos, call from ({_CALLS})")
def extract_tool_calls(spark, sf):
    return _tool_rows(spark, sf)


@query(f"select op_id, call_pos, {_TOOL} as tool from ({_CALLS})")
def classify_tool(spark, sf):
    return _tool_rows(spark, sf).select("op_id", "call_pos", toolcalls.classify_tool(F.col("call")).alias("tool"))


@query(f"""select op_id, call_pos, nullif(regexp_extract(call, 'input_text=\\["([^"]*)"', 1), '') as first,
  case when contains(call, 'input_text') then 2 end as n from ({_CALLS})""")
def list_arg(spark, sf):
    call = F.col("call")
    args = toolcalls.list_args(call)
    return _tool_rows(spark, sf).select(
        "op_id", "call_pos", toolcalls.list_arg(call).alias("first"), F.when(args.isNotNull(), F.size(args)).alias("n")
    )


@query(f"select op_id, call_pos, try_cast(nullif(regexp_extract(call, 'indices=\\[(\\d+)\\]', 1), '') as bigint) as idx from ({_CALLS})")
def index_arg(spark, sf):
    return _tool_rows(spark, sf).select("op_id", "call_pos", toolcalls.index_arg(F.col("call")).alias("idx"))


@query(f"""select op_id, call_pos, nullif(regexp_extract(call, 'subject="([^"]*)"', 1), '') as subject,
  nullif(regexp_extract(call, 'reminder_text="([^"]*)"', 1), '') as body from ({_CALLS})""")
def string_arg(spark, sf):
    call = F.col("call")
    return _tool_rows(spark, sf).select(
        "op_id", "call_pos", toolcalls.string_arg(call, "subject").alias("subject"), toolcalls.string_arg(call, "reminder_text").alias("body")
    )


@query(f"""select op_id, user_id, call_pos, {_TOOL} as tool, nullif(regexp_extract(call, 'input_text=\\["([^"]*)"', 1), '') as text_arg,
  try_cast(nullif(regexp_extract(call, 'indices=\\[(\\d+)\\]', 1), '') as bigint) as index_arg,
  nullif(regexp_extract(call, 'subject="([^"]*)"', 1), '') as subject, nullif(regexp_extract(call, 'reminder_text="([^"]*)"', 1), '') as body
from ({_CALLS}) where {_TOOL} is not null""")
def tool_calls(spark, sf):
    return calls.tool_calls(view(spark, sf, TOOL_LOG)).drop("ts", "item_pos")


@query(f"""select op_id, string_agg('<tool_result>{{"tool":"' || {_TOOL} || '","call_pos":' || call_pos || '}}</tool_result>', chr(10) || chr(10) order by call_pos) as tool_text
from ({_CALLS}) where {_TOOL} is not null group by op_id""")
def tool_results_text(spark, sf):
    return calls.tool_results_text(calls.tool_calls(view(spark, sf, TOOL_LOG)), ["op_id"], ["tool", "call_pos"])
