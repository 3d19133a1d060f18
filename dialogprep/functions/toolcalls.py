"""Column expressions that read tool calls out of reply text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tool names, in the order in which they are looked for.
TOOLS = (
    "add_memory",
    "recall_memories",
    "delete_memory",
    "add_diary",
    "recall_diary",
    "delete_diary",
    "add_reminder",
    "recall_reminders",
    "complete_reminder",
    "delete_reminder",
    "check_watch",
)

# One quoted literal on one line, with backslash escapes; runs of plain characters are taken at once.
_LITERAL = r"""(?:"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+')"""
_OTHER = r"[+-]?\d+(?:\.\d*)?|True|False|None"
_LITERAL_LIST = rf"(?s)^\s*{_LITERAL}(?:\s*,\s*(?:{_LITERAL}|{_OTHER}))*+\s*,?\s*$"


def extract_tool_calls(c: Column) -> Column:
    """All ``<tool_call>`` bodies of a text in order."""
    return F.regexp_extract_all(c, F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))


def classify_tool(call: Column, strict: bool = False) -> Column:
    """Name of the tool: the first known name found anywhere in the call, else null.

    With ``strict`` the call must begin with the name, which keeps text that merely mentions
    another tool from being misrouted.
    """
    out = None
    for name in TOOLS:
        hit = F.rlike(call, F.lit(rf"^\s*{name}\s*\(")) if strict else F.contains(call, F.lit(name))
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def unquote(literal: Column) -> Column:
    """Value of a quoted literal: drop the quotes and resolve the common escapes."""
    inner = F.substr(literal, F.lit(2), F.length(literal) - 2)

    def resolve(piece: Column) -> Column:
        for escape, value in ((r"\n", "\n"), (r"\t", "\t"), (r"\r", "\r"), (r"\"", '"'), (r"\'", "'")):
            piece = F.replace(piece, F.lit(escape), F.lit(value))
        return piece

    # an escaped backslash splits the text first, so that it cannot start another escape
    resolved = F.array_join(F.transform(F.split(inner, r"\\\\"), resolve), "\\")
    return F.when(F.contains(literal, F.lit("\\")), resolved).otherwise(inner)


def list_body(call: Column) -> Column:
    """What stands in ``input_text=[...]`` up to the first ``]``; empty if there is none."""
    return F.regexp_extract(call, r"(?s)input_text\s*=\s*\[(.*?)\]", 1)


def list_values(body: Column) -> Column:
    """The strings of a list without its brackets; null when it does not parse."""
    found = F.regexp_extract_all(body, F.lit(f"({_LITERAL})"), F.lit(1))
    return F.when(F.rlike(body, F.lit(_LITERAL_LIST)), F.transform(found, unquote))


def list_args(call: Column) -> Column:
    """All strings of ``input_text=[...]`` up to the first ``]``; null when it does not parse."""
    return list_values(list_body(call))


def list_arg(call: Column) -> Column:
    """The first string of ``input_text=[...]``; the rest of the list is not used."""
    return F.element_at(list_args(call), 1)


def index_arg(call: Column) -> Column:
    """The number of ``indices=[n]``; null when there are several or none."""
    return F.nullif(F.regexp_extract(call, r"indices\s*=\s*\[(\d+)\]", 1), F.lit("")).try_cast("bigint")


def string_literal(call: Column, name: str) -> Column:
    """What stands behind ``name=``, with its quotes: cut at the next quote of the same kind, empty if there is none."""
    return F.regexp_extract(call, rf"""(?s){name}\s*=\s*(".*?"|'.*?')""", 1)


def literal_value(literal: Column) -> Column:
    """The value of a text that is a quoted literal, null if it is none."""
    return F.when(F.rlike(literal, F.lit(rf"(?s)^{_LITERAL}$")), unquote(literal))


def string_arg(call: Column, name: str) -> Column:
    """The value of ``name="..."``: cut at the next quote of the same kind, null if that is no literal."""
    return literal_value(string_literal(call, name))
