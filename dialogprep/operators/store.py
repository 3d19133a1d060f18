"""Memories, diary pages and reminders as the result of a log of operations.

State is a table of entries. ``replay`` turns a log of tool calls into the entries that remain
and one outcome per call. The listing, batch and statistics functions work on an entries table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dialogprep.functions.clock import iso_local, watch_text
from dialogprep.functions.text import strip_ws
from dialogprep.operators.lists import LIST_BLOCK_ROWS, replay_rows
from dialogprep.operators.order import BLOCK_ROWS, ordered_index, scan
from dialogprep.session import durable

# Wording of the outcome of each operation, by kind of entry.
MESSAGES = {
    "memory": {
        "added": "Successfully added 1 memory.",
        "empty": "No memory stored.",
        "listing": "Memories from the users memory vault: ",
        "missing": "Memory index %s does not exist.",
        "deleted": "Memory at index %s deleted successfully.",
        "not_deleted": "Failed to delete memory at index %s.",
        "updated": "Memory at index %s updated successfully.",
        "nothing_to_delete": "No memories found to delete.",
        "nothing_to_update": "No memories found to update.",
        "none_added": "Failed to add any memories.",
        "some_added": "Added %s memories, failed to add %s memories.",
        "all_added": "Successfully added %s memories.",
        "no_user": "User ID not provided.",
    },
    "diary": {
        "added": "Successfully added 1 page.",
        "empty": "No diary stored.",
        "listing": "Pages from the users diary vault: ",
        "missing": "Diary index %s does not exist.",
        "deleted": "Diary at index %s deleted successfully.",
        "not_deleted": "Failed to delete diary at index %s.",
        "updated": "Diary at index %s updated successfully.",
        "nothing_to_delete": "No pages found to delete.",
        "nothing_to_update": "No pages found to update.",
        "none_added": "Failed to add any pages.",
        "some_added": "Added %s pages, failed to add %s pages.",
        "all_added": "Successfully added %s pages.",
        "no_user": "User ID not provided.",
    },
    "reminder": {
        "added": "Reminder '%s' added.",
        "no_subject": "Reminder subject cannot be empty.",
        "no_body": "Reminder text cannot be empty.",
        "empty": "No reminders waiting.",
        "listing": "Open reminders:\n",
        "missing": "Reminder index %s does not exist.",
        "completed": "Marked '%s' as complete.",
        "deleted": "Deleted reminder '%s'.",
    },
}
BULLETIN_HEADER = "🔔 Reminder bulletin before this chat:"

# The kind of entry and the list operation behind each tool.
TOOL_KIND = {
    "add_memory": ("memory", "add"), "recall_memories": ("memory", "look"), "delete_memory": ("memory", "remove"),
    "add_diary": ("diary", "add"), "recall_diary": ("diary", "look"), "delete_diary": ("diary", "remove"),
    "add_reminder": ("reminder", "add"), "recall_reminders": ("reminder", "look"),
    "complete_reminder": ("reminder", "remove"), "delete_reminder": ("reminder", "remove"),
}

ENTRY_COLUMNS = [
    "kind", "owner", "entry_id", "content", "subject", "body", "created_at", "last_checked_at", "completed_at",
]
_CALL_ORDER = ["ts", "op_id", "call_pos", "item_pos"]


@dataclass(frozen=True)
class Replayed:
    entries: DataFrame  # ENTRY_COLUMNS, deleted entries gone, completed reminders kept
    outcomes: DataFrame  # one row per call
    lifetimes: DataFrame  # every entry ever added, with the places in the log where it came and went


def _choose(column: str, position: int) -> Column:
    chosen = F.create_map(*[F.lit(v) for tool, facts in TOOL_KIND.items() for v in (tool, facts[position])])
    return F.element_at(chosen, F.col(column))


def _say(kind: Column, what: str, *args: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, texts in MESSAGES.items():
        if what in texts:
            out = F.when(kind == name, F.format_string(texts[what], *args) if args else F.lit(texts[what])).otherwise(out)
    return out


#: Looks are cut into stretches of these powers; the coarsest ones hold ``LOOK_FAN ** (LOOK_LEVELS - 1)`` looks.
LOOK_FAN = 8
LOOK_LEVELS = 5


def diary_page(ts: Column, content: Column) -> Column:
    return F.concat(F.date_format(ts, "MMMM dd, yyyy"), F.lit("\n"), content)


def reminder_rejection(subject: Column, body: Column) -> Column:
    """The message for a reminder that cannot be stored, null for a good one."""
    return _stripped_rejection(strip_ws(subject), strip_ws(body))


def _stripped_rejection(subject: Column, body: Column) -> Column:
    texts = MESSAGES["reminder"]
    return F.when(F.coalesce(subject, F.lit("")) == "", F.lit(texts["no_subject"])).when(
        F.coalesce(body, F.lit("")) == "", F.lit(texts["no_body"])
    )


def tools_of(*kinds: str) -> list[str]:
    """The tools that work on the lists of these kinds. Lists of other kinds neither change them nor their ids."""
    return [tool for tool, (kind, _) in TOOL_KIND.items() if kind in kinds]


def after_last_reset(ops: DataFrame, tool: str = "tool") -> DataFrame:
    """Operations that still count: those after the last ``reset`` row of the log."""
    place = F.struct(*_CALL_ORDER)
    last = ops.filter(F.col(tool) == "reset").agg(F.max(place).alias("_reset"))  # one row
    return (
        ops.withColumn("_one", F.lit(1))
        .join(F.broadcast(last.withColumn("_one", F.lit(1))), "_one")
        .filter(F.col("_reset").isNull() | (place > F.col("_reset")))
        .drop("_one", "_reset")
    )


def ids_before_reset(ops: DataFrame, tool: str = "tool") -> dict[str, int]:
    """Ids per kind that were used before the last reset: a reset empties the lists, numbering goes on."""
    place = F.struct(*_CALL_ORDER)
    last = ops.filter(F.col(tool) == "reset").agg(F.max(place).alias("_reset"))  # one row
    kind, op = _choose(tool, 0), _choose(tool, 1)
    stored = (op == "add") & ((F.col(tool) != "add_reminder") | reminder_rejection(F.col("subject"), F.col("body")).isNull())
    earlier = ops.withColumn("_one", F.lit(1)).join(F.broadcast(last.withColumn("_one", F.lit(1))), "_one").filter(stored & (place < F.col("_reset")))
    return {r["kind"]: r["count"] for r in earlier.groupBy(kind.alias("kind")).count().collect()}  # three kinds at most


def list_of_call(diary_owner: str | None = None) -> tuple[Column, Column]:
    """Kind and owner of the list that a call works on; the kind is null for other calls."""
    kind = _choose("tool", 0)
    pages = F.col(diary_owner).cast("string") if diary_owner else F.lit("")
    return kind, F.when(kind == "diary", pages).otherwise(F.col("user_id").cast("string"))


def replay(
    calls: DataFrame, state: DataFrame | None = None, diary_owner: str | None = None, start_ids: dict[str, int] | None = None,
    block_rows: int = LIST_BLOCK_ROWS,
) -> Replayed:
    """Run a log of calls ``(user_id, ts, op_id, call_pos, item_pos, tool, text_arg, index_arg, subject, body)``.

    Memories and reminders belong to ``user_id``; the diary is a single list unless
    ``diary_owner`` names a column that owns pages. ``state`` gives the entries to start from,
    ``start_ids`` the last used id of each kind. Calls that work on no list only pass by, with
    numbers below 0 as ``seq``.
    """
    kind, owner = list_of_call(diary_owner)
    given = calls.withColumns({
        "subject": strip_ws(F.col("subject")), "body": strip_ws(F.col("body")), "kind": kind, "owner": owner, "op": _choose("tool", 1),
    })
    subject, body = F.col("subject"), F.col("body")
    rejected = F.when(F.col("tool") == "add_reminder", _stripped_rejection(subject, body))
    log = ["user_id", *_CALL_ORDER, "tool", "text_arg", "index_arg", "subject", "body", "kind", "op", "list_key"]
    ops = given.withColumns({
        "op": F.when(rejected.isNotNull(), F.lit("look")).otherwise(F.col("op")), "list_key": F.when(F.col("kind").isNotNull(), F.concat_ws("|", "kind", "owner")),
    }).select(*log)
    if state is not None:
        # Open entries join the log as adds that precede it; they keep their ids.
        earlier = state.filter("completed_at is null").select(
            F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("timestamp").alias("ts"),
            F.col("entry_id").alias("op_id"), F.lit(0).cast("bigint").alias("call_pos"),
            F.lit(0).cast("bigint").alias("item_pos"), F.lit(None).cast("string").alias("tool"),
            F.col("content").alias("text_arg"), F.lit(None).cast("bigint").alias("index_arg"), "subject", "body", "kind",
            F.lit("add").alias("op"), F.concat_ws("|", "kind", "owner").alias("list_key"), "entry_id",
            F.col("last_checked_at").alias("checked_before"), F.col("created_at").alias("_created"),
        )
        ops = ops.unionByName(earlier, allowMissingColumns=True)

    # The range exchange reads its input twice, once to sample it; calls may be costly to parse.
    ops = durable(ops.withColumn("_row", F.monotonically_increasing_id()), "ops")
    # Any order of the lists does; numbers tell most rows apart where texts would have to be read. Lists of
    # one number stay apart by their key. Nulls sort first, so starting entries (ts is null) lead their list.
    listed = ops.filter("list_key is not null").drop("_row").withColumn("_list", F.xxhash64("list_key"))
    numbered = ordered_index(listed, ["_list", "list_key", *_CALL_ORDER], "seq").drop("_list")
    # Dense ids in order of insertion, per kind.
    fresh = ordered_index(
        numbered.filter("op = 'add' and tool is not null").select("kind", *_CALL_ORDER, "seq"),
        ["kind", *_CALL_ORDER], "_n",
    )
    kind_first = fresh.groupBy("kind").agg(F.min("_n").alias("_first"))
    used = F.lit(0).cast("long")
    for name, last in (start_ids or {}).items():
        used = F.when(F.col("kind") == name, F.lit(int(last)).cast("long")).otherwise(used)
    ids = fresh.join(F.broadcast(kind_first), "kind").select(  # three kinds at most
        "seq", (F.col("_n") - F.col("_first") + 1 + used).alias("_new_id")
    )

    stepped = numbered.drop("kind").withColumnRenamed("index_arg", "index")
    if ops.filter("tool = 'recall_reminders'").isEmpty():
        nobody = F.lit(None).cast("struct<seq:bigint,ts:timestamp>")
        facts = replay_rows(stepped, ids, ["subject"], ["ts", "tool"], block_rows).withColumns({"_last_seen": nobody, "gone__seen": nobody})
    else:
        stamp = F.when(F.col("tool") == "recall_reminders", F.struct("seq", "ts"))
        timed = scan(
            numbered.filter("kind = 'reminder'").select("list_key", "seq", "tool", "ts"), ["list_key"], "seq",
            max_before={"_seen": stamp}, max_all={"_last_seen": stamp}, block_rows=block_rows,
        ).filter("tool is null or tool <> 'recall_reminders'").select("seq", "_seen", "_last_seen")
        facts = replay_rows(stepped, ids.unionByName(timed, allowMissingColumns=True), ["subject"], ["ts", "tool", "_seen"], block_rows)
    # Entries, outcomes and listings all start from here.
    bar = F.instr("list_key", "|")  # an owner may be null
    facts = facts.withColumnRenamed("index", "index_arg").withColumns({
        "kind": F.substring_index("list_key", "|", 1), "owner": F.when(bar > 0, F.substr("list_key", bar + 1)),
    })
    if state is None:
        facts = facts.withColumns({"entry_id": F.col("_new_id"), "checked_before": F.lit(None).cast("timestamp"), "_created": F.col("ts")})
    else:
        facts = facts.withColumns({"entry_id": F.coalesce("entry_id", "_new_id"), "_created": F.coalesce("_created", F.when(F.col("tool").isNotNull(), F.col("ts")))})
    facts = facts.drop("_new_id", "list_key")

    content = F.when(F.col("kind") == "diary", F.when(F.col("tool").isNull(), F.col("text_arg")).otherwise(
        diary_page(F.col("ts"), F.col("text_arg")))).otherwise(F.col("text_arg"))
    done = F.col("gone_tool") == "complete_reminder"
    seen = F.when(F.col("gone_seq").isNull(), F.col("_last_seen")).otherwise(F.col("gone__seen"))
    seen_ts = F.when(seen["seq"] > F.col("seq"), seen["ts"]).otherwise(F.col("checked_before"))
    lifetimes = facts.filter("op = 'add'").select(
        "kind", "owner", "entry_id", content.alias("content"), "subject", "body", F.col("_created").alias("created_at"),
        F.when(done, F.col("gone_ts")).otherwise(seen_ts).alias("last_checked_at"),
        F.when(done, F.col("gone_ts")).alias("completed_at"), F.col("seq").alias("came_seq"), "gone_seq", F.col("gone_tool").alias("gone_by"),
    )
    entries = lifetimes.filter("gone_seq is null or gone_by = 'complete_reminder'").select(*ENTRY_COLUMNS)
    if state is not None:
        entries = entries.unionByName(state.filter("completed_at is not null").select(*ENTRY_COLUMNS))

    loose = ops.filter("list_key is null").withColumns({"seq": -1 - F.col("_row"), "owner": F.col("user_id").cast("string")})
    facts = facts.unionByName(loose.drop("list_key", "_row"), allowMissingColumns=True)
    k, index = F.col("kind"), F.col("index_arg").cast("string")
    watch = watch_text(F.col("ts"))
    removed = F.when(k == "reminder", F.when(
        F.col("tool") == "complete_reminder", _say(k, "completed", F.col("target_subject"))
    ).otherwise(_say(k, "deleted", F.col("target_subject")))).otherwise(_say(k, "deleted", index))
    added = F.when(k == "reminder", _say(k, "added", F.col("subject"))).otherwise(_say(k, "added"))
    message = (
        F.when(F.col("tool") == "check_watch", watch["message"])
        .when(rejected.isNotNull(), rejected)
        .when(F.col("op") == "add", added)
        .when((F.col("op") == "remove") & F.col("ok"), removed)
        .when(F.col("op") == "remove", _say(k, "missing", index))
        .when(F.col("n_after") == 0, _say(k, "empty"))
    )
    outcomes = facts.filter("tool is not null").select(
        "user_id", *_CALL_ORDER, "tool", "kind", "owner", "seq",
        F.when(rejected.isNotNull(), F.lit(False)).when(F.col("op").isin("add", "remove"), F.col("ok")).alias("success"),
        message.alias("message"), F.when(F.col("op") == "add", F.col("entry_id")).alias("entry_id"),
        F.when(F.col("tool") == "check_watch", watch["timestamp"]).alias("timestamp"), "n_after",
    )
    return Replayed(entries, outcomes, lifetimes)


def _stretch_nodes(lo: Column, hi: Column, fan: int, levels: int) -> Column:
    """``(level, node)`` of the aligned stretches of ``fan ** level`` places that make up ``lo .. hi - 1``.

    A stretch whose parent lies inside as well gives way to it, so a long life has few coarse
    stretches and at most ``2 * (fan - 1)`` finer ones on each level at its ends.
    """
    def between(first: Column, end: Column, level: int) -> Column:
        nodes = F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(nodes, lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))

    def inside(size: int) -> tuple[Column, Column]:
        size = F.lit(size).cast("long")
        return F.call_function("div", lo + size - 1, size), F.call_function("div", hi, size)

    parts = []
    for level in range(levels):
        first, end = inside(fan**level)
        if level + 1 < levels:
            above_first, above_end = inside(fan ** (level + 1))
            whole = above_first < above_end
            parts.append(between(first, F.when(whole, above_first * fan).otherwise(end), level))
            parts.append(between(F.when(whole, above_end * fan).otherwise(end), end, level))
        else:
            parts.append(between(first, end, level))
    return F.flatten(F.array(*parts))


def recall_rows(done: Replayed, fan: int = LOOK_FAN, levels: int = LOOK_LEVELS) -> DataFrame:
    """What each recall call saw: ``(seq, entry_id, content)`` for the entries alive at the call.

    The looks of a list are numbered. An entry lives through a range of those numbers, which is cut
    into aligned stretches, coarse ones in its middle; a look belongs to one stretch of each level. An
    entry and a look it was alive at meet in exactly one stretch, and no others meet, so the join makes
    the rows of the result only. Entries that no look fell upon drop out before it.
    """
    lists = ["kind", "owner"]
    looks = done.outcomes.filter("tool in ('recall_memories', 'recall_diary', 'recall_reminders') and n_after > 0").select(*lists, "seq", F.col("ts").alias("look_ts"))
    lives = done.lifetimes
    look, other = F.lit(1).cast("long").alias("look"), F.lit(0).cast("long").alias("look")
    marks = (
        looks.select(*lists, "seq", look)
        .unionByName(lives.select(*lists, F.col("came_seq").alias("seq"), other))
        .unionByName(lives.filter("gone_seq is not null").select(*lists, F.col("gone_seq").alias("seq"), other))
    )
    counted = durable(scan(marks, lists, "seq", before={"n": F.col("look")}, after={"m": F.col("look")}).select("seq", "n", "m"), "looks")
    came = counted.select(F.col("seq").alias("came_seq"), F.col("n").alias("lo"), (F.col("n") + F.col("m")).alias("end"))
    gone = counted.select(F.col("seq").alias("gone_seq"), F.col("n").alias("upto"))
    lived = lives.join(came, "came_seq").join(gone, "gone_seq", "left").withColumn("hi", F.coalesce("upto", "end")).filter("lo < hi")
    lived = lived.withColumn("at", F.explode(_stretch_nodes(F.col("lo"), F.col("hi"), fan, levels)))
    lived = lived.select(*lists, "at.level", "at.node", "entry_id", "content", "subject", "body", "created_at")
    stretches = F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("div", F.col("n"), F.lit(fan**k).cast("long")).alias("node")) for k in range(levels)])
    placed = looks.join(counted.select("seq", "n"), "seq").withColumn("at", F.explode(stretches)).select(*lists, "at.level", "at.node", "seq", "look_ts")
    return placed.join(lived, [*lists, "level", "node"]).select(*lists, "seq", "look_ts", "entry_id", "content", "subject", "body", "created_at")


def _listing_message(kind: Column, lines: Column) -> Column:
    return F.when(kind == "reminder", F.concat(_say(kind, "listing"), F.array_join(lines, "\n"))).otherwise(
        F.concat(_say(kind, "listing"), F.to_json(lines))
    )


def with_recall_messages(done: Replayed) -> DataFrame:
    """Outcomes with the text of non-empty recalls filled in."""
    rows = recall_rows(done)
    line = F.when(
        F.col("kind") == "reminder", _reminder_text(F.col("subject"), F.col("body"), F.col("created_at"), F.col("look_ts"))
    ).otherwise(F.col("content"))
    lines = rows.groupBy("kind", "seq").agg(F.sort_array(F.collect_list(F.struct("entry_id", line.alias("t")))).alias("_e"))
    texts = lines.select(
        "seq", _listing_message(F.col("kind"), F.transform("_e", lambda e, i: F.concat((i + 1).cast("string"), F.lit(". "), e["t"]))).alias("_text")
    )
    return done.outcomes.join(texts, "seq", "left").withColumn("message", F.coalesce("message", "_text")).drop("_text")


# ---- reading a table of entries -------------------------------------------------------------


def open_entries(entries: DataFrame, kind: str) -> DataFrame:
    return entries.filter((F.col("kind") == kind) & F.col("completed_at").isNull())


def number_entries(entries: DataFrame, out: str = "index", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the 1-based place of each entry in its list, in order of creation."""
    placed = ordered_index(entries, ["kind", "owner", "created_at", "entry_id"], "_seq")
    numbered = scan(placed, ["kind", "owner"], "_seq", before={out: F.lit(1).cast("long")}, block_rows=block_rows)
    return numbered.withColumn(out, F.col(out) + 1).drop("_seq")


def recall(entries: DataFrame, kind: str, owners: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Listing lines ``(owner, index, line)``; owners without entries get the "empty" line."""
    lines = number_entries(open_entries(entries, kind), block_rows=block_rows).select(
        "owner", "index", F.concat(F.col("index").cast("string"), F.lit(". "), F.col("content")).alias("line")
    )
    if owners is None:
        return lines
    none = owners.join(lines.select("owner").distinct(), "owner", "left_anti").select(
        "owner", F.lit(0).cast("long").alias("index"), F.lit(MESSAGES[kind]["empty"]).alias("line")
    )
    return lines.unionByName(none)


def recall_message(lines: DataFrame, kind: str) -> DataFrame:
    """One listing message per owner; the message is the whole list by definition."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("index", "line"))), lambda r: r["line"])
    return lines.groupBy("owner").agg(ordered.alias("_l")).select(
        "owner",
        F.when(F.col("_l")[0] == MESSAGES[kind]["empty"], F.col("_l")[0]).otherwise(_listing_message(F.lit(kind), F.col("_l"))).alias("message"),
    )


def open_reminders(entries: DataFrame, stamp: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Open reminders, numbered per owner; ``stamp`` sets when they were last checked."""
    rows = number_entries(open_entries(entries, "reminder"), block_rows=block_rows)
    return rows if stamp is None else rows.withColumn("last_checked_at", stamp)


def _reminder_text(subject: Column, body: Column, created: Column, checked: Column) -> Column:
    return F.concat(
        subject, F.lit(" — "), body, F.lit(" (Created: "),
        F.coalesce(F.date_format(created, "yyyy-MM-dd HH:mm:ss"), F.lit("Unknown")), F.lit(", Last checked: "),
        F.coalesce(iso_local(checked), F.lit("Not yet checked")), F.lit(")"),
    )


def reminder_lines(reminders: DataFrame) -> DataFrame:
    text = _reminder_text(F.col("subject"), F.col("body"), F.col("created_at"), F.col("last_checked_at"))
    return reminders.select("owner", "index", F.concat(F.col("index").cast("string"), F.lit(". "), text).alias("line"))


def bulletin(entries: DataFrame, stamp: Column, owners: DataFrame | None = None) -> DataFrame:
    """Per owner the reminder bulletin; null for owners in ``owners`` without open reminders."""
    lines = reminder_lines(open_reminders(entries, stamp))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("index", "line"))), lambda r: r["line"])
    texts = lines.groupBy("owner").agg(
        F.concat(F.lit(BULLETIN_HEADER + "\n"), F.array_join(ordered, "\n")).alias("bulletin")
    )
    return texts if owners is None else owners.join(texts, "owner", "left")


def opening_messages(system_prompt: Column, bulletin_text: Column) -> Column:
    """The system prompt, followed by the bulletin as a second system message when there is one."""
    def message(content: Column) -> Column:
        return F.struct(F.lit("system").alias("role"), content.alias("content"))

    alone = F.array(message(system_prompt))
    return F.when(bulletin_text.isNull(), alone).otherwise(F.concat(alone, F.array(message(bulletin_text))))


def store_stats(entries: DataFrame) -> DataFrame:
    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    kind = F.col("kind")
    return entries.agg(
        count(kind == "memory").alias("memories"),
        count(kind == "diary").alias("diary_pages"),
        count((kind == "reminder") & F.col("completed_at").isNull()).alias("open_reminders"),
    )


# ---- batch operations against one snapshot --------------------------------------------------


def split_by_user(ops: DataFrame, kind: str = "memory") -> tuple[DataFrame, DataFrame]:
    """Operations with a user, and the rejects with a message."""
    missing = F.coalesce(F.col("user_id"), F.lit("")) == ""
    return ops.filter(~missing), ops.filter(missing).withColumn("message", F.lit(MESSAGES[kind]["no_user"]))


def batch_add(ops: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Add lists of texts ``(op_id, owner, ts, items)``: new entries, and one message per operation.

    A null text cannot be stored. Pages get a date line.
    """
    items = ops.select("op_id", "owner", "ts", F.posexplode("items").alias("pos", "item"))
    good = items.filter("item is not null")
    text = diary_page(F.col("ts"), F.col("item")) if kind == "diary" else F.col("item")
    entries = good.select(F.lit(kind).alias("kind"), "owner", "op_id", "pos", text.alias("content"), F.col("ts").alias("created_at"))
    n_good = F.size(F.filter("items", lambda i: i.isNotNull())).cast("long")
    n_bad = F.size("items") - n_good
    says = MESSAGES[kind]
    message = (
        F.when(n_good == 0, F.lit(says["none_added"]))
        .when(n_bad > 0, F.format_string(says["some_added"], n_good, n_bad))
        .otherwise(F.format_string(says["all_added"], n_good))
    )
    return entries, ops.select("op_id", "owner", n_good.alias("n_added"), n_bad.cast("long").alias("n_failed"), message.alias("message"))


def _against_snapshot(ops: DataFrame, state: DataFrame, kind: str, items: str) -> tuple[DataFrame, DataFrame]:
    """Batch items next to the entry their index names, and the numbered snapshot."""
    snapshot = number_entries(open_entries(state, kind))
    rows = ops.select("op_id", "owner", F.posexplode(items).alias("pos", "item"))
    index = F.col("item.index") if items == "updates" else F.col("item")
    rows = rows.withColumn("index", index.cast("long"))
    # (owner, index) names one entry, so this join has no hot key
    hit = rows.join(snapshot.select("owner", "index", "entry_id"), ["owner", "index"], "left")
    stocked = snapshot.select("owner").distinct().withColumn("stocked", F.lit(True))
    return hit.join(stocked, "owner", "left").withColumn("stocked", F.coalesce("stocked", F.lit(False))), snapshot


def _batch_message(ops: DataFrame, items: DataFrame, snapshot: DataFrame, nothing: str) -> DataFrame:
    """One message per operation: its item messages on separate lines (a group is one batch).

    An operation without items has an empty message, or ``nothing`` on an empty list.
    """
    each = items.groupBy("op_id", "owner").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "message"))), lambda r: r["message"]).alias("_m")
    )
    stocked = snapshot.select("owner").distinct().withColumn("_s", F.lit(True))
    told = ops.select("op_id", "owner").join(each, ["op_id", "owner"], "left").join(stocked, "owner", "left")
    return told.select("op_id", "owner", F.when(F.col("_s"), F.coalesce(F.array_join("_m", "\n"), F.lit(""))).otherwise(F.lit(nothing)).alias("message"))


def batch_delete(ops: DataFrame, state: DataFrame, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delete lists of places ``(op_id, owner, indices)``, all counted in the same snapshot.

    Returns survivors, per-item outcomes, and one message per operation. A place named twice
    in a batch fails the second time.
    """
    says = MESSAGES[kind]
    rows, snapshot = _against_snapshot(ops, state, kind, "indices")
    again = F.row_number().over(W.partitionBy("op_id", "owner", "index").orderBy("pos")) > 1  # inside one batch
    text = F.col("index").cast("string")
    items = rows.withColumn("ok", F.col("entry_id").isNotNull() & ~again).withColumn(
        "message",
        F.when(F.col("entry_id").isNull(), F.format_string(says["missing"], text))
        .when(F.col("ok"), F.format_string(says["deleted"], text))
        .otherwise(F.format_string(says["not_deleted"], text)),
    )
    gone = items.filter("ok").select("owner", "entry_id").distinct()
    survivors = snapshot.join(gone, ["owner", "entry_id"], "left_anti")
    return survivors, items, _batch_message(ops, items, snapshot, says["nothing_to_delete"])


def batch_update(ops: DataFrame, state: DataFrame, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Replace texts ``(op_id, owner, updates: array<struct<index, content>>)`` in one snapshot.

    An item without index or content is malformed. The last write to an entry stays.
    """
    says = MESSAGES[kind]
    rows, snapshot = _against_snapshot(ops, state, kind, "updates")
    malformed = F.col("item.index").isNull() | F.col("item.content").isNull()
    text = F.col("index").cast("string")
    items = rows.withColumn("ok", ~malformed & F.col("entry_id").isNotNull()).withColumn(
        "message",
        F.when(malformed, F.concat(F.lit("Invalid update item format: "), F.to_json("item")))
        .when(F.col("entry_id").isNull(), F.format_string(says["missing"], text))
        .otherwise(F.format_string(says["updated"], text)),
    )
    last = items.filter("ok").groupBy("owner", "entry_id").agg(F.max_by("item.content", F.struct("op_id", "pos")).alias("_new"))
    updated = snapshot.join(last, ["owner", "entry_id"], "left").withColumn("content", F.coalesce("_new", "content")).drop("_new")
    return updated, items, _batch_message(ops, items, snapshot, says["nothing_to_update"])


def status_events(ops: DataFrame, items: DataFrame, messages: DataFrame, verb: str, kind: str = "memory") -> DataFrame:
    """Events ``(op_id, seq, status, description, done)`` of batch deletes or updates.

    ``verb`` is delete or update. One event opens an operation, one reports each item, one
    closes it; on an empty store a single failure replaces the last two.
    """
    participle, noun, plural = {
        "delete": ("Deleting", "deletions", "nothing_to_delete"), "update": ("Updating", "updates", "nothing_to_update"),
    }[verb]
    things = {"memory": "memory", "diary": "diary"}[kind]
    says = MESSAGES[kind]
    listed = "indices" if verb == "delete" else "updates"
    size = F.when(F.col(listed).isNull(), F.lit(0)).otherwise(F.size(listed))

    def event(seq: Column, status: Column | str, description: Column, done: bool) -> Column:
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(
            seq.cast("long").alias("seq"), status.alias("status"), description.alias("description"), F.lit(done).alias("done")
        )

    opened = ops.select("op_id", F.explode(F.array(event(
        F.lit(0), f"{verb}_in_progress",
        F.concat(F.lit(f"{participle} "), size.cast("string"), F.lit(f" {things} entries.")), False,
    ))).alias("e"), size.alias("_n"))
    stocked = items.filter("stocked")
    each = stocked.select("op_id", event(
        F.col("pos") + 1, F.when(F.col("ok"), F.lit(f"{verb}_success")).otherwise(F.lit(f"{verb}_failed")), F.col("message"), False
    ).alias("e"))
    state = messages.select("op_id", (F.col("message") == says[plural]).alias("_none"), "message")
    closed = opened.select("op_id", "_n").join(state, "op_id").select("op_id", F.when(
        F.col("_none"), event(F.lit(1), f"{verb}_failed", F.col("message"), True)
    ).otherwise(event(
        F.col("_n") + 1, f"{verb}_complete", F.lit(f"All requested {things} {noun} have been processed."), True
    )).alias("e"))
    return opened.select("op_id", "e").unionByName(each).unionByName(closed).select("op_id", "e.*")


# Wording of the opening and closing events of additions and listings.
EVENT_TEXTS = {
    "memory": {"add": "Adding entries to the memory vault.", "recall": "Retrieving stored memories.", "loaded": "%s memories loaded"},
    "diary": {"add": "Adding entries to the high tech diary.", "recall": "Retrieving Diary Entries.", "loaded": "%s diary pages loaded"},
}


def _two_events(ops: DataFrame, verb: str, opening: str, failed: Column, closing: Column) -> DataFrame:
    first = F.struct(
        F.lit(0).cast("long").alias("seq"), F.lit(f"{verb}_in_progress").alias("status"),
        F.lit(opening).alias("description"), F.lit(False).alias("done"),
    )
    last = F.struct(
        F.lit(1).cast("long").alias("seq"),
        F.when(failed, F.lit(f"{verb}_failed")).otherwise(F.lit(f"{verb}_complete")).alias("status"),
        closing.alias("description"), F.lit(True).alias("done"),
    )
    return ops.select("op_id", F.explode(F.array(first, last)).alias("e")).select("op_id", "e.*")


def add_events(messages: DataFrame, kind: str = "memory") -> DataFrame:
    """Events of batch additions, from their outcome messages."""
    failed = F.col("message") == MESSAGES[kind]["none_added"]
    return _two_events(messages, "add", EVENT_TEXTS[kind]["add"], failed, F.col("message"))


def recall_events(ops: DataFrame, entries: DataFrame, kind: str = "memory") -> DataFrame:
    """Events of listings ``(op_id, owner)`` of a table of entries."""
    sizes = open_entries(entries, kind).groupBy("owner").agg(F.count(F.lit(1)).alias("_n"))
    closing = F.coalesce(
        F.format_string(EVENT_TEXTS[kind]["loaded"], F.nullif(F.col("_n"), F.lit(0)).cast("string")),
        F.lit(MESSAGES[kind]["empty"]),
    )
    closing = F.when(F.col("_n").isNull(), F.lit(MESSAGES[kind]["empty"])).otherwise(closing)
    return _two_events(ops.join(sizes, "owner", "left"), "recall", EVENT_TEXTS[kind]["recall"], F.lit(False), closing)


def reject_events(rejects: DataFrame) -> DataFrame:
    """The single event of an operation without a user."""
    return rejects.select(
        "op_id", F.lit(0).cast("long").alias("seq"), F.lit("missing_user_id").alias("status"),
        F.col("message").alias("description"), F.lit(True).alias("done"),
    )
