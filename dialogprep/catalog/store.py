"""The event-sourced store: replays, listings, batch operations, events.

The logs only ever remove the first entry of a list, so SQL can state the result: the length
of a list is its running sum of steps, reflected at zero, and the k-th successful removal
takes the k-th entry added.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dialogprep.catalog.registry import query
from dialogprep.catalog.views import DIARY_LOG, REMINDER_DELETE_LOG, REMINDER_LOG, TOOL_LOG, table, view
from dialogprep.functions.clock import watch_text
from dialogprep.operators import store
from dialogprep.operators.calls import tool_calls
from dialogprep.session import durable, scratch_path
from dialogprep.streaming import replay as streaming

_TIME = "%Y-%m-%d %H:%M:%S.%f"


def _t(column) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _calls(spark, sf, log, *kinds):
    """The calls of a log; with ``kinds``, of those that work on lists of these kinds."""
    return tool_calls(view(spark, sf, log), tools=store.tools_of(*kinds) if kinds else None)


def _replay(spark, sf, log=TOOL_LOG, *kinds):
    return store.replay(_calls(spark, sf, log, *kinds))


def fifo(add: str, remove: str, owner: str = "user_id::varchar", p: str = "m", source: str = "events") -> str:
    """CTEs ``{p}_steps`` (n_before, n_after per event) and ``{p}_lives`` (when each entry came and went)."""
    return f""" {p}_ops as (select {owner} as owner, event_id, ts, event_type,
     case event_type when '{add}' then 1 when '{remove}' then -1 else 0 end as d from {source}),
 {p}_sums as (select *, sum(d) over (partition by owner order by ts, event_id) as sm from {p}_ops),
 {p}_len as (select *, (sm - least(0, min(sm) over (partition by owner order by ts, event_id)))::bigint as n_after from {p}_sums),
 {p}_steps as (select *, coalesce(lag(n_after) over (partition by owner order by ts, event_id), 0) as n_before from {p}_len),
 {p}_adds as (select *, row_number() over (partition by owner order by ts, event_id) as k, row_number() over (order by ts, event_id) as entry_id
   from {p}_steps where d = 1),
 {p}_dels as (select *, row_number() over (partition by owner order by ts, event_id) as k from {p}_steps where d = -1 and n_before > 0),
 {p}_lives as (select a.owner, a.entry_id, a.event_id, a.ts, d.ts as gone_ts, d.event_id as gone_op
   from {p}_adds a left join {p}_dels d on d.owner = a.owner and d.k = a.k)"""


MEMORY = fifo("signup", "error")
DIARY = fifo("signup", "error", owner="''", p="d")
REMINDER = fifo("click", "purchase", p="r")
_OPEN_MEMORY = """(select owner, entry_id, 'm' || event_id as content, ts, row_number() over (partition by owner order by entry_id) as idx
   from m_lives where gone_op is null)"""

# US rule since 2007: summer time from the second Sunday of March to the first Sunday of November, 2:00 local
_SUMMER = """(ts >= make_date(year(ts), 3, 8) + ((7 - dayofweek(make_date(year(ts), 3, 8))) % 7)::int + interval 9 hour
  and ts < make_date(year(ts), 11, 1) + ((7 - dayofweek(make_date(year(ts), 11, 1))) % 7)::int + interval 8 hour)"""
_WATCH = f"""'It''s currently ' || strftime(ts - case when {_SUMMER} then interval 6 hour else interval 7 hour end, '%A, %B %d, %Y at %I:%M %p ')
  || case when {_SUMMER} then 'MDT' else 'MST' end || ' (Bozeman time).'"""


@query(f"with {MEMORY} select event_id as op_id, true as success, 'Successfully added 1 memory.' as message, entry_id from m_adds")
def add_memory(spark, sf):
    return _replay(spark, sf, TOOL_LOG, "memory").outcomes.filter("tool = 'add_memory'").select("op_id", "success", "message", "entry_id")


_USERS = "(select distinct user_id::varchar as owner from events union select 'nobody')"


@query(f"""with {MEMORY}, o as (select * from {_OPEN_MEMORY})
select owner, idx as "index", idx || '. ' || content as line from o
union all select owner, 0, 'No memory stored.' from {_USERS} where owner not in (select owner from o)""")
def recall_memories(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("owner")).distinct()
    nobody = users.limit(1).select(F.lit("nobody").alias("owner"))
    return store.recall(_replay(spark, sf, TOOL_LOG, "memory").entries, "memory", users.unionByName(nobody))


@query(f"""with {MEMORY}, o as (select owner, list(idx || '. ' || content order by idx) as l from {_OPEN_MEMORY} group by owner)
select owner, 'Memories from the users memory vault: ' || to_json(l)::varchar as message from o""")
def recall_message(spark, sf):
    return store.recall_message(store.recall(_replay(spark, sf, TOOL_LOG, "memory").entries, "memory"), "memory")


@query(f"""with {MEMORY} select event_id as op_id, n_before > 0 as success,
  case when n_before > 0 then 'Memory at index 1 deleted successfully.' else 'Memory index 1 does not exist.' end as message, n_after
from m_steps where d = -1""")
def delete_memory(spark, sf):
    return _replay(spark, sf, TOOL_LOG, "memory").outcomes.filter("tool = 'delete_memory'").select("op_id", "success", "message", "n_after")


@query(f"""with {DIARY} select entry_id, strftime(ts, '%B %d, %Y') || chr(10) || 'm' || event_id as content, strftime(ts, '{_TIME}') as created_at
from d_lives where gone_op is null""")
def add_diary(spark, sf):
    entries = _replay(spark, sf, DIARY_LOG, "diary").entries.filter("kind = 'diary'")
    return entries.select("entry_id", "content", _t("created_at").alias("created_at"))


@query(f"""with {DIARY} select '' as owner, i as "index", i || '. ' || strftime(ts, '%B %d, %Y') || chr(10) || 'm' || event_id as line
from (select *, row_number() over (order by entry_id) as i from d_lives where gone_op is null)""")
def recall_diary(spark, sf):
    return store.recall(_replay(spark, sf, DIARY_LOG, "diary").entries, "diary")


@query(f"""with {DIARY} select event_id as op_id, n_before > 0 as success, n_after,
  case when n_before > 0 then 'Diary at index 1 deleted successfully.' else 'Diary index 1 does not exist.' end as message from d_steps where d = -1""")
def delete_diary(spark, sf):
    return _replay(spark, sf, DIARY_LOG, "diary").outcomes.filter("tool = 'delete_diary'").select("op_id", "success", "message", "n_after")


_OWN_DIARY = fifo("signup", "error", p="o")


@query(f"""with {_OWN_DIARY} select owner, entry_id, strftime(ts, '%B %d, %Y') || chr(10) || 'm' || event_id as content from o_lives where gone_op is null""")
def diary_by_owner(spark, sf):
    entries = store.replay(_calls(spark, sf, DIARY_LOG, "diary"), diary_owner="user_id").entries
    return entries.filter("kind = 'diary'").select("owner", "entry_id", "content")


def _reminder_calls(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("op_id"), F.col("user_id").cast("string").alias("user_id"), "ts", F.lit(0).cast("long").alias("call_pos"),
        F.lit(0).cast("long").alias("item_pos"), F.lit("add_reminder").alias("tool"), F.lit(None).cast("string").alias("text_arg"),
        F.lit(None).cast("bigint").alias("index_arg"),
        F.expr("case when event_id % 5 = 0 then ' \n ' else concat('  s', event_id, '\t') end").alias("subject"),
        F.expr("case when event_id % 3 = 0 then '' else concat(event_type, ' ') end").alias("body"),
    )


@query("""select event_id as op_id, bad is null as success, coalesce(bad, 'Reminder ''s' || event_id || ''' added.') as message,
  case when bad is null then sum((bad is null)::int) over (order by ts, event_id)::bigint end as entry_id
from (select *, case when event_id % 5 = 0 then 'Reminder subject cannot be empty.' when event_id % 3 = 0 then 'Reminder text cannot be empty.' end as bad from events)""")
def add_reminder(spark, sf):
    return store.replay(_reminder_calls(spark, sf)).outcomes.select("op_id", "success", "message", "entry_id")


@query(f"""with {REMINDER} select owner, row_number() over (partition by owner order by entry_id) as "index", 's' || event_id as subject,
  'r' || event_id as body from r_lives where gone_op is null""")
def open_reminders(spark, sf):
    return store.open_reminders(_replay(spark, sf, TOOL_LOG, "reminder").entries).select("owner", "index", "subject", "body")


@query(f"""with {REMINDER} select v.event_id as op_id, l.entry_id, 's' || l.event_id as subject
from events v join r_lives l on l.owner = v.user_id::varchar and l.ts < v.ts and (l.gone_ts is null or l.gone_ts > v.ts) where v.event_type = 'view'""")
def recall_reminders(spark, sf):
    done = _replay(spark, sf, REMINDER_LOG, "reminder")
    seen = store.recall_rows(done).filter("kind = 'reminder'")
    return seen.join(done.outcomes.select("seq", "op_id"), "seq").select("op_id", "entry_id", "subject")


@query(f"""with {REMINDER} select entry_id, strftime(completed_at, '{_TIME}') as completed_at, strftime(checked, '{_TIME}') as last_checked_at from (
  select l.entry_id, l.gone_ts as completed_at, coalesce(l.gone_ts, max(v.ts)) as checked
  from r_lives l left join events v on v.event_type = 'view' and v.user_id::varchar = l.owner and v.ts > l.ts
  group by l.entry_id, l.gone_ts)""")
def reminder_stamps(spark, sf):
    entries = _replay(spark, sf, REMINDER_LOG, "reminder").entries.filter("kind = 'reminder'")
    return entries.select("entry_id", _t("completed_at").alias("completed_at"), _t("last_checked_at").alias("last_checked_at"))


_REMOVED = """case when s.n_before = 0 then 'Reminder index 1 does not exist.' else {text} end as message
from r_steps s left join r_lives l on l.gone_op = s.event_id where s.d = -1"""


@query(f"with {REMINDER} select s.event_id as op_id, s.n_before > 0 as success, "
       + _REMOVED.format(text="'Marked ''s' || l.event_id || ''' as complete.'"))
def complete_reminder(spark, sf):
    return _replay(spark, sf, TOOL_LOG, "reminder").outcomes.filter("tool = 'complete_reminder'").select("op_id", "success", "message")


@query(f"with {REMINDER} select s.event_id as op_id, s.n_before > 0 as success, "
       + _REMOVED.format(text="'Deleted reminder ''s' || l.event_id || '''.'"))
def delete_reminder(spark, sf):
    return _replay(spark, sf, REMINDER_DELETE_LOG, "reminder").outcomes.filter("tool = 'delete_reminder'").select("op_id", "success", "message")


@query(f"""with {REMINDER}, b as (select owner, '🔔 Reminder bulletin before this chat:' || chr(10) || string_agg(i || '. s' || event_id || ' — r' || event_id
    || ' (Created: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ', Last checked: 2024-05-31T18:00:00-06:00)', chr(10) order by i) as bulletin
  from (select *, row_number() over (partition by owner order by entry_id) as i from r_lives where gone_op is null) group by owner)
select u.owner, b.bulletin, case when b.bulletin is null then 1 else 2 end as n_system from (select distinct user_id::varchar as owner from events) u left join b on b.owner = u.owner""")
def bulletin(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("owner")).distinct()
    stamp = F.lit("2024-06-01 00:00:00").cast("timestamp")
    texts = store.bulletin(_replay(spark, sf, TOOL_LOG, "reminder").entries, stamp, users)
    return texts.withColumn("n_system", F.size(store.opening_messages(F.lit("S"), F.col("bulletin"))))


@query(f"""select event_id, {_WATCH} as message, strftime(ts - case when {_SUMMER} then interval 6 hour else interval 7 hour end, '%Y-%m-%dT%H:%M:%S')
  || case when strftime(ts, '%f') = '000000' then '' else '.' || strftime(ts, '%f') end || case when {_SUMMER} then '-06:00' else '-07:00' end as timestamp
from (select event_id, ts + to_days((event_id % 400)::int) as ts from events)""")
def watch_clock(spark, sf):
    ts = F.col("ts") + F.make_dt_interval((F.col("event_id") % 400).cast("int"))
    return table(spark, sf, "events").withColumn("w", watch_text(ts)).select("event_id", "w.message", "w.timestamp")


@query(f"""with {MEMORY}, {REMINDER} select (select count(*) from m_lives where gone_op is null) as memories, 0::bigint as diary_pages,
  (select count(*) from r_lives where gone_op is null) as open_reminders""")
def store_stats(spark, sf):
    return store.store_stats(_replay(spark, sf).entries)


_LATE = "(select * from events where (ts, event_id) > (select (ts, event_id) from events where event_id % 2000 = 999 order by ts desc, event_id desc limit 1))"
_AFTER = fifo("signup", "error", source=_LATE)


_BEFORE = """(select count(*) from events where event_type = 'signup' and event_id % 2000 <> 999
  and (ts, event_id) < (select (ts, event_id) from events where event_id % 2000 = 999 order by ts desc, event_id desc limit 1))"""


@query(f"with {_AFTER} select owner, (entry_id + {_BEFORE})::bigint as entry_id, 'm' || event_id as content from m_lives where gone_op is null")
def reset_store(spark, sf):
    calls = _calls(spark, sf, TOOL_LOG)
    tool = F.when(F.col("op_id") % 2000 == 999, F.lit("reset")).otherwise(F.col("tool"))
    calls = durable(calls.withColumn("tool", tool), "calls")
    left, used = store.after_last_reset(calls), store.ids_before_reset(calls)
    return store.replay(left, start_ids=used).entries.filter("kind = 'memory'").select("owner", "entry_id", "content")


# ---- batches against one snapshot -----------------------------------------------------------


def _snapshot(spark, sf):
    """Open memories, or diary pages with owners, as a written table."""
    return durable(_replay(spark, sf, TOOL_LOG, "memory").entries, "snapshot")


def _diary_snapshot(spark, sf):
    return durable(store.replay(_calls(spark, sf, DIARY_LOG, "diary"), diary_owner="user_id").entries, "snapshot")


def _batches(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct()
    k = F.col("user_id")
    return users.select(
        k.alias("op_id"), k.cast("string").alias("owner"), F.array(F.lit(1), k % 5 + 1, F.lit(2), F.lit(2), F.lit(0)).alias("indices"),
        F.array(*[
            F.struct(i.cast("int").alias("index"), F.when(k % 4 != 3, F.concat(F.lit(name), k)).alias("content"))
            for name, i in (("a", F.lit(1)), ("b", k % 5 + 1), ("c", F.lit(2)))
        ]).alias("updates"),
    )


_BATCHES = "(select distinct user_id as op_id, user_id::varchar as owner from events)"


def _diary_sql(text: str) -> str:
    """The same check for pages: other entries, other words."""
    pages = """(select owner, entry_id, strftime(ts, '%B %d, %Y') || chr(10) || 'm' || event_id as content, ts,
   row_number() over (partition by owner order by entry_id) as idx from m_lives where gone_op is null)"""
    return (
        text.replace(_OPEN_MEMORY, pages).replace("'Memory ", "'Diary ").replace("delete memory", "delete diary")
        .replace("No memories found", "No pages found")
    )


_DELETE_ITEMS = f"""with {MEMORY}, s as (select * from {_OPEN_MEMORY}),
 i as (select op_id, owner, pos - 1 as pos, l[pos] as idx from (select *, [1, op_id % 5 + 1, 2, 2, 0] as l from {_BATCHES}), lateral (select unnest(range(1, 6)) as pos)),
 j as (select i.*, s.entry_id, s.entry_id is not null and row_number() over (partition by i.op_id, i.idx order by i.pos) = 1 as ok,
   i.owner in (select owner from s) as stocked from i left join s on s.owner = i.owner and s.idx = i.idx),
 items as (select *, case when entry_id is null then 'Memory index ' || idx || ' does not exist.' when ok then 'Memory at index ' || idx || ' deleted successfully.'
   else 'Failed to delete memory at index ' || idx || '.' end as message from j),
 m as (select op_id, owner, case when bool_and(stocked) then string_agg(message, chr(10) order by pos) else 'No memories found to delete.' end as message from items group by op_id, owner)
"""
_DELETE_SURVIVORS = _DELETE_ITEMS + "select s.owner, s.idx as \"index\", s.content from s where not exists (select 1 from items where ok and items.owner = s.owner and items.entry_id = s.entry_id)"
_DELETE_MESSAGES = _DELETE_ITEMS + "select op_id, owner, message from m"

_UPDATE_ITEMS = f"""with {MEMORY}, s as (select * from {_OPEN_MEMORY}),
 i as (select op_id, owner, pos - 1 as pos, [1, op_id % 5 + 1, 2][pos] as idx, case when op_id % 4 <> 3 then ['a', 'b', 'c'][pos] || op_id end as new
   from {_BATCHES}, lateral (select unnest(range(1, 4)) as pos)),
 j as (select i.*, s.entry_id, s.entry_id is not null and new is not null as ok, i.owner in (select owner from s) as stocked
   from i left join s on s.owner = i.owner and s.idx = i.idx),
 items as (select *, case when new is null then 'Invalid update item format: {{"index":' || idx || '}}' when entry_id is null then 'Memory index ' || idx || ' does not exist.'
   else 'Memory at index ' || idx || ' updated successfully.' end as message from j),
 m as (select op_id, owner, case when bool_and(stocked) then string_agg(message, chr(10) order by pos) else 'No memories found to update.' end as message from items group by op_id, owner)
"""
_UPDATE_STATE = _UPDATE_ITEMS + """select s.owner, s.idx as "index", coalesce(u.new, s.content) as content
from s left join (select owner, entry_id, arg_max(new, pos) as new from items where ok group by owner, entry_id) u on u.owner = s.owner and u.entry_id = s.entry_id"""
_UPDATE_MESSAGES = _UPDATE_ITEMS + "select op_id, owner, message from m"


@query(_DELETE_SURVIVORS)
def batch_delete_memory(spark, sf):
    return store.batch_delete(_batches(spark, sf), _snapshot(spark, sf), "memory")[0].select("owner", "index", "content")


@query(_DELETE_MESSAGES)
def batch_delete_memory_messages(spark, sf):
    return store.batch_delete(_batches(spark, sf), _snapshot(spark, sf), "memory")[2]


@query(_UPDATE_STATE)
def batch_update_memory(spark, sf):
    return store.batch_update(_batches(spark, sf), _snapshot(spark, sf), "memory")[0].select("owner", "index", "content")


@query(_UPDATE_MESSAGES)
def batch_update_memory_messages(spark, sf):
    return store.batch_update(_batches(spark, sf), _snapshot(spark, sf), "memory")[2]


@query(_diary_sql(_DELETE_SURVIVORS))
def batch_delete_diary(spark, sf):
    return store.batch_delete(_batches(spark, sf), _diary_snapshot(spark, sf), "diary")[0].select("owner", "index", "content")


@query(_diary_sql(_DELETE_MESSAGES))
def batch_delete_diary_messages(spark, sf):
    return store.batch_delete(_batches(spark, sf), _diary_snapshot(spark, sf), "diary")[2]


@query(_diary_sql(_UPDATE_STATE))
def batch_update_diary(spark, sf):
    return store.batch_update(_batches(spark, sf), _diary_snapshot(spark, sf), "diary")[0].select("owner", "index", "content")


@query(_diary_sql(_UPDATE_MESSAGES))
def batch_update_diary_messages(spark, sf):
    return store.batch_update(_batches(spark, sf), _diary_snapshot(spark, sf), "diary")[2]


def _add_batches(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").alias("op_id"), F.col("user_id").cast("string").alias("owner"), "ts",
        F.expr("""array(case when event_id % 7 <> 0 then concat('a', event_id) end, case when event_id % 21 = 14 then concat('b', event_id) end,
          case when event_id % 7 <> 0 and event_id % 3 <> 0 then concat('c', event_id) end)""").alias("items"),
    )


_ADD_ITEMS = """(select event_id as op_id, ts, user_id::varchar as owner, pos - 1 as pos, [case when event_id % 7 <> 0 then 'a' || event_id end,
  case when event_id % 21 = 14 then 'b' || event_id end, case when event_id % 7 <> 0 and event_id % 3 <> 0 then 'c' || event_id end][pos] as item
 from events, lateral (select unnest(range(1, 4)) as pos))"""
_ADD_MESSAGES = f"""select op_id, owner, n_added, n_failed, case when n_added = 0 then 'Failed to add any memories.'
  when n_failed > 0 then 'Added ' || n_added || ' memories, failed to add ' || n_failed || ' memories.' else 'Successfully added ' || n_added || ' memories.' end as message
from (select op_id, owner, count(item) as n_added, count(*) - count(item) as n_failed from {_ADD_ITEMS} group by op_id, owner)"""


@query(f"select op_id, owner, pos::int as pos, item as content from {_ADD_ITEMS} where item is not null")
def batch_add_memory(spark, sf):
    return store.batch_add(_add_batches(spark, sf), "memory")[0].select("op_id", "owner", "pos", "content")


@query(_ADD_MESSAGES)
def batch_add_memory_messages(spark, sf):
    return store.batch_add(_add_batches(spark, sf), "memory")[1]


@query(f"select op_id, owner, pos::int as pos, strftime(ts, '%B %d, %Y') || chr(10) || item as content from {_ADD_ITEMS} where item is not null")
def batch_add_diary(spark, sf):
    return store.batch_add(_add_batches(spark, sf), "diary")[0].select("op_id", "owner", "pos", "content")


@query(_ADD_MESSAGES.replace("memories", "pages"))
def batch_add_diary_messages(spark, sf):
    return store.batch_add(_add_batches(spark, sf), "diary")[1]


@query("""select event_id as op_id, case when user_id % 10 in (0, 5) then 'User ID not provided.' end as message from events""")
def require_user(spark, sf):
    ops = table(spark, sf, "events").select(
        F.col("event_id").alias("op_id"),
        F.expr("case when user_id % 10 = 0 then '' when user_id % 10 = 5 then null else cast(user_id as string) end").alias("user_id"),
    )
    good, rejected = store.split_by_user(ops)
    return good.select("op_id", F.lit(None).cast("string").alias("message")).unionByName(rejected.select("op_id", "message"))


_EVENTS = {
    "delete": (_DELETE_ITEMS, "Deleting 5 memory entries.", "deletions", 5),
    "update": (_UPDATE_ITEMS, "Updating 3 memory entries.", "updates", 3),
}


def _events_sql(verb: str) -> str:
    items, opening, noun, n = _EVENTS[verb]
    return items + f"""select op_id, 0::bigint as seq, '{verb}_in_progress' as status, '{opening}' as description, false as done from m
union all select op_id, pos + 1, case when ok then '{verb}_success' else '{verb}_failed' end, message, false from items where stocked
union all select op_id, case when message like 'No memories found%' then 1 else {n + 1} end,
  case when message like 'No memories found%' then '{verb}_failed' else '{verb}_complete' end,
  case when message like 'No memories found%' then message else 'All requested memory {noun} have been processed.' end, true from m"""


@query(_events_sql("delete"))
def status_events_delete(spark, sf):
    ops = _batches(spark, sf)
    _, items, messages = store.batch_delete(ops, _snapshot(spark, sf), "memory")
    return store.status_events(ops, items, messages, "delete")


@query(_events_sql("update"))
def status_events_update(spark, sf):
    ops = _batches(spark, sf)
    _, items, messages = store.batch_update(ops, _snapshot(spark, sf), "memory")
    return store.status_events(ops, items, messages, "update")


@query(f"""with a as ({_ADD_MESSAGES})
select op_id, 0::bigint as seq, 'add_in_progress' as status, 'Adding entries to the memory vault.' as description, false as done from a
union all select op_id, 1, case when n_added = 0 then 'add_failed' else 'add_complete' end, message, true from a""")
def status_events_add(spark, sf):
    return store.add_events(store.batch_add(_add_batches(spark, sf), "memory")[1])


@query(f"""with {MEMORY}, s as (select owner, count(*) as n from m_lives where gone_op is null group by owner)
select op_id, 0::bigint as seq, 'recall_in_progress' as status, 'Retrieving stored memories.' as description, false as done from {_BATCHES}
union all select b.op_id, 1, 'recall_complete', coalesce(s.n || ' memories loaded', 'No memory stored.'), true from {_BATCHES} b left join s on s.owner = b.owner""")
def status_events_recall(spark, sf):
    return store.recall_events(_batches(spark, sf).select("op_id", "owner"), _replay(spark, sf, TOOL_LOG, "memory").entries)


# ---- whole logs -----------------------------------------------------------------------------

_ENTRIES = f"""with {MEMORY}, {REMINDER}
select 'memory' as kind, owner, entry_id, 'm' || event_id as content, null::varchar as subject, strftime(ts, '{_TIME}') as created_at, null::varchar as completed_at
from m_lives where gone_op is null
union all select 'reminder', owner, entry_id, null, 's' || event_id, strftime(ts, '{_TIME}'), strftime(gone_ts, '{_TIME}') from r_lives"""


def _entry_rows(entries):
    return entries.select("kind", "owner", "entry_id", "content", "subject", _t("created_at").alias("created_at"), _t("completed_at").alias("completed_at"))


@query(_ENTRIES)
def replay_entries(spark, sf):
    return _entry_rows(_replay(spark, sf).entries)


@query(f"""with {MEMORY}, {REMINDER}, alive as (
  select v.event_id, to_json(list(i || '. m' || e order by i))::varchar as l from (
    select v.event_id, m.event_id as e, row_number() over (partition by v.event_id order by m.entry_id) as i
    from events v join m_lives m on m.owner = v.user_id::varchar and m.ts < v.ts and (m.gone_ts is null or m.gone_ts > v.ts) where v.event_type = 'view') v group by v.event_id)
select event_id as op_id, 0::bigint as call_pos, 'add_memory' as tool, true as success, 'Successfully added 1 memory.' as message, entry_id from m_adds
union all select event_id, 0, 'delete_memory', n_before > 0,
  case when n_before > 0 then 'Memory at index 1 deleted successfully.' else 'Memory index 1 does not exist.' end, null from m_steps where d = -1
union all select s.event_id, 0, 'recall_memories', null, case when n_after = 0 then 'No memory stored.' else 'Memories from the users memory vault: ' || a.l end, null
  from m_steps s left join alive a on a.event_id = s.event_id where event_type = 'view'
union all select event_id, 0, 'add_reminder', true, 'Reminder ''s' || event_id || ''' added.', entry_id from r_adds
union all select event_id, 1, 'check_watch', null, {_WATCH}, null from events where event_type = 'click'
union all select s.event_id, 0, 'complete_reminder', s.n_before > 0,
  case when s.n_before = 0 then 'Reminder index 1 does not exist.' else 'Marked ''s' || l.event_id || ''' as complete.' end, null
  from r_steps s left join r_lives l on l.gone_op = s.event_id where s.d = -1""")
def replay_outcomes(spark, sf):
    return store.with_recall_messages(_replay(spark, sf)).select("op_id", "call_pos", "tool", "success", "message", "entry_id")


@query(_ENTRIES)
def replay_stream(spark, sf):
    """The log arrives in three parts, each a run of the stream over what is new."""
    calls = durable(_calls(spark, sf, TOOL_LOG), "calls")
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "store", "stream"))
    cuts = calls.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    third = (cuts["b"] - cuts["a"]) / 3
    parts = [F.col("ts") < cuts["a"] + third, F.col("ts").between(cuts["a"] + third, cuts["a"] + 2 * third), F.col("ts") > cuts["a"] + 2 * third]
    for part in parts:
        calls.filter(part).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(calls.schema).parquet(inbox)
        streaming.replay_stream(source, out, checkpoint).awaitTermination()
    return _entry_rows(streaming.current_entries(spark, out))
