"""Line-first quality rules, in DataFrame functions only.

A document is first cleaned line by line: each line with a word is held against punctuation,
navigation and boilerplate rules, and lines that fail go. A document that loses more than
``max_lost`` of its words that way is rejected, as is one that fails the base rules on
length and repetition. Everything is computed inside the row, so no key can be hot and nothing
is shuffled.

Null text counts as empty; an empty text has no words and fails the base rule. Repeated rows are
judged alike, and other columns pass through untouched (columns named like an output are replaced).
``accepted`` keeps all columns, and takes the failing lines out of the texts that pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
NAVIGATION = r"[|»›•·>]"
SHOUTS = r"[!?]{2,}"
ENDS = r"[.!?…。！？:;][\"'”’»)\]]*[\x20\x09-\x0D]*$"
# fixed values: phrases that page furniture is made of, in lower case
BOILERPLATE = (
    "all rights reserved", "cookie policy", "cookie settings", "accept cookies", "accept all cookies", "uses cookies",
    "privacy policy", "terms of use", "terms of service", "click here", "read more", "sign up now", "sign in to", "log in to",
    "subscribe to", "share this", "share on", "enable javascript", "lorem ipsum", "powered by", "skip to content",
    "skip to main content", "back to top", "add to cart",
)
MAX_BOILERPLATE_WORDS = 30

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5
MAX_SYMBOLS_PER_WORD = 0.34
MIN_WORDS_PER_SEPARATOR = 4
MAX_SHOUTS_PER_WORD = 0.34


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def count_of(text: Column, pattern: str) -> Column:
    """How often ``pattern`` matches in ``text``."""
    return F.size(F.split(text, pattern)) - 1


def window_longs(hashes: Column, n: Column, bits: Column) -> Column:
    """Sorted longs, one per window of three words: the window's hash above ``bits``, its place below.

    ``bits`` must hold ``n``, so a text of a thousand words leaves 54 bits of hash, one of a million 44.
    """
    window = lambda i: F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i), F.get(hashes, i + 1))
    longs = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.coalesce(
        F.call_function("shiftleft", F.call_function("shiftrightunsigned", window(i), bits), bits).bitwiseOR(i.cast("long")), F.lit(0)))
    return F.when(n >= 3, F.sort_array(longs)).otherwise(F.array().cast("array<bigint>"))


def repeated_words(longs: Column, bits: Column) -> Column:
    """Words in windows that occur twice or more, the first occurrence included, from ``window_longs``."""
    tag = lambda x: F.call_function("shiftrightunsigned", x, bits)
    twice = F.filter(longs, lambda x, k: (tag(x) == tag(F.get(longs, k - 1))) | (tag(x) == tag(F.get(longs, k + 1))))
    starts = F.sort_array(F.transform(twice, lambda x: x - F.call_function("shiftleft", tag(x), bits)))
    three = F.lit(3).cast("long")
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(three, x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )


def line_fails(line: Column, n: Column, symbols: Column) -> Column:
    """Whether a line of ``n`` > 0 words is furniture rather than prose."""
    separators = count_of(line, NAVIGATION)
    phrase = F.exists(F.transform(F.array(F.lower(line)), lambda low: F.exists(
        F.array(*map(F.lit, BOILERPLATE)), lambda p: F.contains(low, p))), lambda found: found)
    marked = (separators >= F.greatest(F.lit(2), F.ceil(n / MIN_WORDS_PER_SEPARATOR))) | (count_of(line, SHOUTS) > MAX_SHOUTS_PER_WORD * n)
    return (
        (symbols > MAX_SYMBOLS_PER_WORD * n)
        | ((n >= 4) & ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}"))
        | ((n < 3) & ~line.rlike(ENDS))
        | (line.rlike(f"{NAVIGATION}|{SHOUTS}") & marked)
        | ((n < MAX_BOILERPLATE_WORDS) & phrase)
    )


def _lines(body: Column) -> Column:
    """The lines that have a word, as ``(line, n, symbols)``."""
    counted = F.transform(F.split(body, "\n"), lambda x: F.struct(
        x.alias("line"), F.size(words(x)).alias("n"), count_of(x, SYMBOLS).alias("symbols")))
    return F.filter(counted, lambda s: s["n"] > 0)


def score(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Add counts, ``base_failed``, ``lost`` (share of words in failed lines), ``cleaned`` and ``kept``."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumns({"_words": words(F.col(text)), "_lines": _lines(body)}).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        # a symbol is a word character, so every symbol stands in a line with a word
        "n_symbols": F.aggregate("_lines", F.lit(0).cast("long"), lambda a, s: a + s["symbols"]),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        "_n": F.size("_words"),
        "_bits": F.length(F.bin(F.size("_words"))),
        "_distinct": F.size(F.array_distinct(F.col("_lines.line"))),
    }).withColumn("_longs", window_longs(F.col("_hashes"), F.col("_n"), F.col("_bits"))).withColumns({
        "n_dup_lines": (F.size("_lines") - F.col("_distinct")).cast("long"),
        "n_repeat_words": repeated_words(F.col("_longs"), F.col("_bits")),
    })
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = F.filter("_lines", lambda s: ~line_fails(s["line"], s["n"], s["symbols"]))
    judged = counted.withColumns({"base_failed": base, "_good": good})
    left = F.aggregate("_good", F.lit(0).cast("long"), lambda a, s: a + s["n"])
    lost = F.when(F.col("n_words") > 0, 1 - left / F.col("n_words")).otherwise(F.lit(1.0))
    # of equal lines the first stays: array_distinct keeps first occurrences in order
    judged = judged.withColumn("cleaned", F.array_join(F.array_distinct(F.col("_good.line")), "\n"))
    return judged.withColumn("lost", lost).withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= max_lost)).drop(
        "_words", "_lines", "_hashes", "_n", "_bits", "_longs", "_distinct", "_good")


def without_failing_lines(text: Column) -> Column:
    """``text`` without the lines that fail. Lines without words and repeated lines stay."""
    def stays(x: Column) -> Column:
        n = F.size(words(x))
        return (n == 0) | ~line_fails(x, n, count_of(x, SYMBOLS))

    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")


def accepted(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST, length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns, their texts without the lines that fail.

    ``length``, where there is such a column, follows a text that has lost lines.
    """
    scored = score(docs.withColumn("_row", F.struct("*")), text, max_lost)
    # the id keeps the filter above the steps that share their results
    kept = scored.withColumn("_at", F.monotonically_increasing_id()).filter(F.col("kept") & (F.col("_at") >= 0)).select("_row.*", F.col("lost").alias("_lost"))
    out = kept.withColumn(text, F.when(F.col("_lost") > 0, without_failing_lines(F.col(text))).otherwise(F.col(text)))
    if length in docs.columns:
        out = out.withColumn(length, F.when(F.col("_lost") > 0, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return out.select(docs.columns)
