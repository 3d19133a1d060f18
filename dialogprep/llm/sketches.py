"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs: lines, long ones further at sentence ends. Each paragraph has a
digest of 48 bits with a check of 16. A sketch has three tables of ``CELLS`` cells; a digest goes to
one cell of each table, where a count goes up and the digest is xor-ed in. Two versions of a text
are compared by subtracting their cells: paragraphs in both cancel out, and a cell whose count is
one or minus one and whose check holds gives a differing digest away. Taking that digest out of its
other cells frees more (peeling). If something is left at the end, both texts are sketched anew
at a larger size, with digests split over groups of cells and other hash functions.

Likeness is the share of paragraphs in both among all. Two texts without paragraphs are alike (1),
one without and one with are not (0). Everything but finding the next document happens inside the row.
The text goes through one exchange, by id; from the next document only its digests and the
replacing characters are passed on.

Null text counts as empty. Rows are ordered by id, null first; of rows with the same id the one
whose text has the smallest SHA-256 is what the previous id's rows are edited with. The only
document of a table is its own next. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.order import ordered_index
from dialogprep.session import durable

CELLS = 32
#: Digests of both texts together that a group of cells is sized for when a comparison is repeated.
GROUP_DIGESTS = 40
RETRIES = 5
ROUNDS = 16
PARAGRAPH = r"(?m)[^\n]{64,192}?(?:[.!?](?=\s)|$)|[^\n]{1,192}"
_NO_ID = -(2**63)


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def digests(text: Column) -> Column:
    """Distinct paragraph digests."""
    high = lambda p: F.xxhash64(p).bitwiseAND(_long(~0xFFFF))
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: _checked(high(p))))


def _checked(high: Column) -> Column:
    return high.bitwiseOR(F.xxhash64(high).bitwiseAND(_long(0xFFFF)))


def _is_digest(k: Column) -> Column:
    high = k.bitwiseAND(_long(~0xFFFF))
    return F.xxhash64(high).bitwiseAND(_long(0xFFFF)) == k.bitwiseAND(_long(0xFFFF))


def _hash(k: Column, seed: Column) -> Column:
    """Five bits of it are the cell in each table, those above the group."""
    return F.xxhash64(k, seed)


def _cell(h: Column, table: int) -> Column:
    """The cell in a table, from 0, for a hash."""
    return F.call_function("shiftrightunsigned", h, F.lit(5 * table)).bitwiseAND(_long(CELLS - 1)).cast("int")


def _put(cells: Column, at: Column, k: Column, n: Column) -> Column:
    """``cells`` with digest ``k`` xor-ed into cell ``at`` and ``n`` added to its count."""
    old = F.get(cells, at)
    new = F.struct((old["n"] + n).alias("n"), old["k"].bitwiseXOR(k).alias("k"))
    # flatten copies stretches of an array at once, concat goes element by element
    return F.flatten(F.array(F.slice(cells, F.lit(1), at), F.array(new), F.slice(cells, at + 2, F.lit(CELLS))))


def _put_all(sketch: Column, hashed: Column, sign: int) -> Column:
    """``sketch`` with each of ``hashed(k, h, n)`` put in, its count times ``sign``."""
    return F.aggregate(hashed, sketch, lambda t, x: F.struct(
        *[_put(t[f"t{j}"], _cell(x["h"], j), x["k"], x["n"] * sign).alias(f"t{j}") for j in range(3)]))


def _empty() -> Column:
    cells = F.array_repeat(F.struct(F.lit(0).alias("n"), _long(0).alias("k")), CELLS)
    return F.struct(*[cells.alias(f"t{j}") for j in range(3)])


def sketch(keys: Column, seed: int = 0) -> Column:
    """One group of cells holding ``keys``."""
    return _put_all(_empty(), _hashed(keys, F.lit(seed)), 1)


def _hashed(keys: Column, seed: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("k"), _hash(k, seed).alias("h"), F.lit(1).alias("n")))


def subtract(a: Column, b: Column) -> Column:
    """The cells of ``a`` less those of ``b``."""
    less = lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"))
    return F.struct(*[F.zip_with(a[f"t{j}"], b[f"t{j}"], less).alias(f"t{j}") for j in range(3)])


def _bare(cells: Column, table: int, seed: Column) -> Column:
    """``(k, h, n)`` of the digests that stand alone in a cell."""
    alone = F.filter(cells, lambda x, i: (F.abs(x["n"]) == 1) & _is_digest(x["k"]) & (_cell(_hash(x["k"], seed), table) == i))
    return F.transform(alone, lambda x: F.struct(x["k"].alias("k"), _hash(x["k"], seed).alias("h"), x["n"].alias("n")))


def peel(difference: Column, seed: Column | int = 0, rounds: int = ROUNDS) -> Column:
    """``(ok, plus, minus)``: whether all came out, and the digests only in the first and only in the second.

    The tables are peeled in turn, so no digest is found twice in a step; three steps without a find end it.
    """
    seed = F.lit(seed) if isinstance(seed, int) else seed
    none = F.array().cast("array<bigint>")
    start = F.struct(difference.alias("cells"), none.alias("plus"), none.alias("minus"), F.lit(0).alias("still"))
    signed = lambda found, n: F.transform(F.filter(found, lambda x: x["n"] == n), lambda x: x["k"])

    def step(table: int):
        def go(state: Column) -> Column:
            # the transform names a step's finds, so that they are not searched again for each use
            named = F.transform(F.array(_bare(state["cells"][f"t{table}"], table, seed)), lambda f: F.when(
                F.size(f) == 0, F.struct(state["cells"].alias("cells"), state["plus"].alias("plus"), state["minus"].alias("minus"), (state["still"] + 1).alias("still"))
            ).otherwise(F.struct(
                _put_all(state["cells"], f, -1).alias("cells"), F.concat(state["plus"], signed(f, 1)).alias("plus"),
                F.concat(state["minus"], signed(f, -1)).alias("minus"), F.lit(0).alias("still"))))
            return F.when(state["still"] >= 3, state).otherwise(F.get(named, F.lit(0)))

        return go

    def turn(state: Column, i: Column) -> Column:
        table = i % 3
        return F.when(table == 0, step(0)(state)).when(table == 1, step(1)(state)).otherwise(step(2)(state))

    def finish(state: Column) -> Column:
        clean = [F.forall(state["cells"][f"t{j}"], lambda x: (x["n"] == 0) & (x["k"] == 0)) for j in range(3)]
        return F.struct((clean[0] & clean[1] & clean[2]).alias("ok"), state["plus"].alias("plus"), state["minus"].alias("minus"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(3 * rounds - 1)), start, turn, finish)


def _compare(a: Column, b: Column, groups: Column, seed: Column) -> Column:
    """``(ok, plus, minus)`` of two sets of digests, sketched in ``groups`` groups of cells each; sizes, not digests."""
    above = lambda h: F.pmod(F.call_function("shiftrightunsigned", h, F.lit(15)), groups)
    part = lambda hashed, g: F.filter(hashed, lambda x: above(x["h"]) == g)
    both = F.array(F.struct(_hashed(a, seed).alias("a"), _hashed(b, seed).alias("b")))
    each = F.get(F.transform(both, lambda s: F.transform(F.sequence(_long(0), groups - 1), lambda g: peel(
        # the cells of the second are subtracted as they are filled
        _put_all(_put_all(_empty(), part(s["a"], g), 1), part(s["b"], g), -1), seed))), F.lit(0))
    zero = F.struct(F.lit(True).alias("ok"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    return F.aggregate(each, zero, lambda s, r: F.struct(
        (s["ok"] & r["ok"]).alias("ok"), (s["plus"] + F.size(r["plus"])).alias("plus"), (s["minus"] + F.size(r["minus"])).alias("minus")))


def likeness(rows: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, out: str) -> DataFrame:
    """Add ``out``: the likeness of the texts with digests ``a`` and ``b`` and base sketches ``sketch_a`` and ``sketch_b``.

    The base sketches are compared first. A comparison that leaves cells behind is repeated with
    ``GROUP_DIGESTS`` digests per group, then with twice as many groups each time. Should even the last
    one fail (each does so with a chance of a few per cent), the digests themselves are compared.
    """
    first = peel(subtract(F.col(sketch_a), F.col(sketch_b)))
    sized = lambda r: F.struct(r["ok"].alias("ok"), F.size(r["plus"]).alias("plus"), F.size(r["minus"]).alias("minus"))
    rows = rows.withColumn("_p", first).withColumn("_r0", sized(F.col("_p")))
    groups = F.greatest(_long(1), F.ceil((F.size(a) + F.size(b)) / GROUP_DIGESTS))
    for k in range(1, RETRIES + 1):
        again = _compare(F.col(a), F.col(b), groups * 2 ** (k - 1), F.lit(k))
        rows = rows.withColumn(f"_r{k}", F.when(F.col(f"_r{k - 1}")["ok"], F.col(f"_r{k - 1}")).otherwise(again))
    last = F.col(f"_r{RETRIES}")
    plus = F.when(last["ok"], last["plus"]).otherwise(F.size(F.array_except(a, b)))
    minus = F.when(last["ok"], last["minus"]).otherwise(F.size(F.array_except(b, a)))
    both = F.size(a) - plus
    share = F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (both + plus + minus))
    return rows.withColumn(out, share).drop("_p", *[f"_r{k}" for k in range(RETRIES + 1)])


def as_text(sk: Column) -> Column:
    """A sketch as hex: four digits of count and sixteen of xor-ed digests per cell."""
    cell = lambda c: F.concat(F.lpad(F.hex(c["n"].bitwiseAND(F.lit(0xFFFF))), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"))
    return F.lower(F.array_join(F.transform(F.flatten(F.array(*[sk[f"t{j}"] for j in range(3)])), cell), ""))


def _links(base: DataFrame) -> DataFrame:
    """``(key, to, take)``: the id before each id, and a quarter of the longest text there."""
    ids = ordered_index(base.groupBy("key").agg(F.max(F.length("text")).alias("n")), ["key"], "pos")
    ids = durable(ids.select("key", "n", "pos"), "order")
    total = ids.count()
    before = ids.select(F.col("key").alias("to"), F.floor(F.col("n") / 4).cast("int").alias("take"), F.pmod(F.col("pos") + 1, F.lit(max(1, total))).alias("pos"))
    return durable(ids.select("key", "pos").join(before, "pos").select("key", "to", "take"), "next")


def versions(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_chars, edited, digests, edited_digests, next_digests)`` of every row.

    ``edited`` is the text whose last quarter is replaced by as much of the next document's beginning.
    """
    base = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_NO_ID)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    passed = base.join(_links(base), "key").select(
        F.col("to").alias("key"), F.struct(F.sha2("text", 256).alias("sha"), F.expr("substring(text, 1, take)").alias("head"), digests(F.col("text")).alias("digests")).alias("next"))
    passed = passed.groupBy("key").agg(F.min_by("next", "next.sha").alias("next"))
    rows = base.join(passed, "key").withColumn("n_chars", F.length("text")).withColumn("q", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(F.expr("substring(text, 1, n_chars - q)"), F.expr("substring(next.head, 1, q)"))
    out = rows.withColumn("edited", edited).withColumns({"own": digests(F.col("text")), "changed": digests(F.col("edited"))})
    return out.select(
        F.when(F.col("key") != _NO_ID, F.col("key")).alias("id"), F.col("n_chars").cast("long").alias("n_chars"), "edited",
        F.col("own").alias("digests"), F.col("changed").alias("edited_digests"), F.col("next.digests").alias("next_digests"))


def fingerprinted(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row."""
    rows = versions(docs, id, text).withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    rows = rows.withColumns({"_a": sketch(F.col("digests")), "_b": sketch(F.col("edited_digests")), "_c": sketch(F.col("next_digests"))})
    rows = likeness(rows, "digests", "edited_digests", "_a", "_b", "near_edited")
    rows = likeness(rows, "digests", "next_digests", "_a", "_c", "near_next")
    return rows.select("id", "n_chars", "edited_sha256", as_text(F.col("_a")).alias("fingerprint"), as_text(F.col("_b")).alias("edited_fingerprint"), "near_edited", "near_next")
