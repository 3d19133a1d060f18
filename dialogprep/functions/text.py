"""Column expressions for reasoning markup in replies. Nothing here leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup of a reasoning section and the sentence used when there is none.
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
DEFAULT_THINKING = "Let me consider this question..."


def strip_ws(c: Column) -> Column:
    """Trim all white space, not only blanks as ``trim`` does."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lstrip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "")


def after_first(c: Column, mark: str) -> Column:
    """Text after the first ``mark``; the caller checks that there is one."""
    return F.substr(c, F.instr(c, mark) + F.lit(len(mark)))


def before_first(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, 1)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def has_thinking(c: Column) -> Column:
    return F.contains(_text(c), F.lit(THINK_OPEN))


def strip_thinking(c: Column) -> Column:
    """Visible text: what follows the first closing tag, else the text without stray tags."""
    c = _text(c)
    bare = F.replace(c, F.lit(THINK_OPEN), F.lit(""))
    return strip_ws(F.when(F.contains(c, F.lit(THINK_CLOSE)), after_first(c, THINK_CLOSE)).otherwise(bare))


def clean_visible(c: Column, mantra: str) -> Column:
    """Drop reasoning that leaked to the front of a reply, and every repeat of the mantra."""
    leading = r"(?sU)^\s*(?>(?:</think>|<think>(?:.*?</think>)?)\s*)*"
    repeated = rf"(?U)<self>\s*{re.escape(mantra)}\s*</self>"
    return strip_ws(F.regexp_replace(F.regexp_replace(_text(c), leading, ""), repeated, ""))


def thinking_block(c: Column, mantra: str) -> Column:
    return F.concat(F.lit(f"{THINK_OPEN}\n<self>{mantra}</self>\n"), c, F.lit(f"\n{THINK_CLOSE}"))


def split_thinking(c: Column) -> Column:
    """``struct(thinking, answer)``; thinking is null when there is no complete section."""
    c = _text(c)
    rest = after_first(c, THINK_OPEN)
    whole = F.contains(c, F.lit(THINK_OPEN)) & F.contains(rest, F.lit(THINK_CLOSE))
    return F.struct(
        F.when(whole, strip_ws(before_first(rest, THINK_CLOSE))).alias("thinking"),
        F.when(whole, lstrip_ws(after_first(rest, THINK_CLOSE))).otherwise(strip_ws(c)).alias("answer"),
    )


def rename_user(c: Column, name: str) -> Column:
    return F.replace(F.replace(c, F.lit("the user"), F.lit(name)), F.lit("The user"), F.lit(name))


def assemble_reply(original: Column, rewritten: Column, name: str, mantra: str) -> Column:
    """Final reply: a reasoning block (rewritten, else original, else a default) and the answer."""
    parts = split_thinking(original)
    thinking, answer = parts["thinking"], parts["answer"]
    revised = F.when(_text(rewritten) != "", strip_thinking(rename_user(rewritten, name))).otherwise(thinking)
    body = F.when(_text(thinking) != "", revised).otherwise(F.lit(DEFAULT_THINKING))
    return F.concat(thinking_block(body, mantra), F.lit("\n\n"), clean_visible(answer, mantra))


def replace_thinking(c: Column, rewritten: Column, name: str) -> Column:
    """Swap the first complete reasoning section in place and keep the text on both sides."""
    rest = after_first(c, THINK_OPEN)
    usable = F.contains(c, F.lit(THINK_OPEN)) & F.contains(rest, F.lit(THINK_CLOSE)) & (_text(rewritten) != "")
    revised = strip_ws(F.regexp_replace(rename_user(rewritten, name), r"(?i)</?think>", ""))
    swapped = F.concat(
        before_first(c, THINK_OPEN), F.lit(f"{THINK_OPEN}\n"), revised, F.lit(f"\n{THINK_CLOSE}"),
        after_first(rest, THINK_CLOSE),
    )
    return F.when(usable, swapped).otherwise(c)


def rewrite_source(c: Column) -> Column:
    """The reasoning text handed to a rewriter, null when there is none."""
    return F.nullif(split_thinking(c)["thinking"], F.lit(""))


def extract_question(c: Column) -> Column:
    mark = f"{THINK_CLOSE}\n\n"
    tail = F.when(F.contains(c, F.lit(mark)), after_first(c, mark))
    return strip_ws(F.coalesce(F.nullif(tail, F.lit("")), c))


def preview_text(c: Column, width: int = 80) -> Column:
    return F.concat(F.substring(c, 1, width), F.lit("..."))


def splice(reply: Column, continuation: Column) -> Column:
    """Reply and continuation on separate lines; an empty continuation changes nothing."""
    return F.when(_text(continuation) != "", F.concat(reply, F.lit("\n"), continuation)).otherwise(reply)
