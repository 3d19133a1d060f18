"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@query()
def op5_quality_rules(spark, sf_dir):
    from dialogprep.llm import quality

    return quality.score(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost")


PIECES = "/opt/tokenizers/piece_bpe_32k.model"

# DuckDB has no hash order of its own to take: md5 of the same strings gives the same order
MIX_SQL = r"""
with d as (select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size from documents),
p as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (select *, [3, 1, 2][(rank % 3 + 1)::int] as w from p),
f as (select *, source_size::double / w as filled from w),
l as (select *, (1.5 * (sum(source_size) over ())::double - 2 * coalesce(sum(source_size) over e, 0)::double)
    / (sum(w) over () - coalesce(sum(w) over e, 0))::double as level from f
  window e as (order by filled, rank rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(coalesce((select arg_min(level, (filled, rank)) from l where level <= 2 * filled) * w, 2 * source_size::double),
    2 * source_size::double) as target from l),
o as (select d.*, t.source_size, t.target, coalesce(sum(size) over (partition by d.source order by md5('20240|' || coalesce(doc_id::varchar, '')), doc_id, size
    rows between unbounded preceding and 1 preceding), 0)::bigint as before from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before)))::bigint as taken
from o"""


@query(MIX_SQL)
def op6_source_mix(spark, sf_dir):
    from dialogprep.llm import mixing
    from dialogprep.session import durable

    sized = documents(spark, sf_dir).select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    plan = mixing.planned(durable(sized, "sizes"))
    ordered = plan.orderBy(F.get("copies", F.lit(0))["position"].asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_secret_scans(spark, sf_dir):
    from dialogprep.llm import secrets

    found = secrets.scanned(documents(spark, sf_dir).select("doc_id", "text"))
    base = ("assign", "access", "hex")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


@query()
def op8_piece_encoding(spark, sf_dir):
    from dialogprep.llm import pieces

    coded = pieces.encoded(documents(spark, sf_dir).select("doc_id", "text"), PIECES)
    back = pieces.byte_tokens(pieces.decoded(coded, PIECES), PIECES)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_byte_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query()
def op9_simhash(spark, sf_dir):
    from dialogprep.llm import simhash

    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op3_html_extraction(spark, sf_dir):
    from dialogprep.llm import html

    return html.extracted(pages(spark, sf_dir)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


WARC_SQL = r"""
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as sha from pages),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001',
    '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', substr(sha, i::int, 1))]), '') as bits,
  min(page_id) over (partition by sha) as first from p)
select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1
    + 16 * substr(bits, (5 * k + 1)::int, 1)::int + 8 * substr(bits, (5 * k + 2)::int, 1)::int + 4 * substr(bits, (5 * k + 3)::int, 1)::int
    + 2 * substr(bits, (5 * k + 4)::int, 1)::int + substr(bits, (5 * k + 5)::int, 1)::int)::int, 1)), '') as payload_digest,
  case when page_id > first then 'revisit' else 'response' end as record_type, case when page_id > first then first end as refers_to
from b"""


@query(WARC_SQL)
def op4_warc(spark, sf_dir):
    from dialogprep.llm import warc
    from dialogprep.session import scratch_path

    path = scratch_path(spark, "warc")
    warc.write(pages(spark, sf_dir), path)
    found = warc.read(spark, path, payload=False).filter(F.col("record_type").isin("response", "revisit"))
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


@query()
def op10_suffix_dedup(spark, sf_dir):
    from dialogprep.llm import suffixes

    return suffixes.deduplicated(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query()
def op2_document_fingerprints(spark, sf_dir):
    from dialogprep.llm import sketches

    return sketches.fingerprinted(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query()
def op1_license_scans(spark, sf_dir):
    from dialogprep.llm import licences

    found = licences.scanned(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licensed"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"),
        F.array_max(F.col("licences.probability")).alias("probability"),
        F.array_join(F.transform("licences", lambda r: F.concat_ws(":", r["paragraph"], r["family"])), ",").alias("paragraphs"))


EXACT_SQL = """
with d as (select doc_id, coalesce(text, '') as content from documents),
g as (select content, max(doc_id) as keep_id, count(*)::bigint as group_size from d group by content)
select doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id is null) as kept, sha256(content) as text_sha256 from d join g using (content)"""


@query(EXACT_SQL)
def op13_exact_dedup(spark, sf_dir):
    from dialogprep.llm import exact

    found = exact.groups_of(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), exact.stays(F.col("id"), F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


# DuckDB has no crc32: the bits of each character's byte go through the polynomial one by one
MANIFEST_SQL = r"""
with recursive d as (select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
  coalesce(xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, e: case when e >= 0 then xor(a, e) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)) % 3 = 0, false) as touched from documents),
h as (select *, coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-') || coalesce(strlen(source)::varchar || ':' || source, '-')
  || coalesce(strlen(lang)::varchar || ':' || lang, '-') || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') as head from d),
l as (select doc_id, lang, sha256(head || coalesce(strlen(text)::varchar || ':' || text, '-')) as leaf,
  sha256(head || case when touched then coalesce(strlen(low)::varchar || ':' || low, '-') else coalesce(strlen(text)::varchar || ':' || text, '-') end) as claimed,
  row_number() over (partition by lang order by doc_id nulls first) - 1 as pos, count(*) over (partition by lang) as n from h),
nodes as (select lang, 0 as lev, pos, n, leaf as dig from l
  union all select lang, lev + 1, pos // 8, (n + 7) // 8, sha256(string_agg(dig, '' order by pos)) from nodes where n > 1 group by lang, lev, pos // 8, n),
subs as (select lang, dig as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
up as (select 0 as lev, pos, n, subroot as dig from subs
  union all select lev + 1, pos // 8, (n + 7) // 8, sha256(string_agg(dig, '' order by pos)) from up where n > 1 group by lev, pos // 8, n),
sib as (select lang, lev, pos, coalesce(string_agg(dig, '') over (w rows between unbounded preceding and 1 preceding), '') as a,
  coalesce(string_agg(dig, '') over (w rows between 1 following and unbounded following), '') as b from nodes where n > 1 window w as (partition by lang, lev, pos // 8 order by pos)),
upsib as (select lev, pos, coalesce(string_agg(dig, '') over (w rows between unbounded preceding and 1 preceding), '') as a,
  coalesce(string_agg(dig, '') over (w rows between 1 following and unbounded following), '') as b from up where n > 1 window w as (partition by lev, pos // 8 order by pos)),
walk as (select doc_id, lang, 0 as lev, pos, claimed as cur, '' as shown from l
  union all select w.doc_id, w.lang, w.lev + 1, w.pos // 8, sha256(s.a || w.cur || s.b), w.shown || s.a || s.b
  from walk w join sib s on w.lang is not distinct from s.lang and w.lev = s.lev and w.pos = s.pos),
walked as (select doc_id, lang, arg_max(cur, lev) as cur, arg_max(shown, lev) as shown from walk group by doc_id, lang),
rest as (select doc_id, w.lang, 0 as lev, s.pos, cur, shown from walked w join subs s on w.lang is not distinct from s.lang
  union all select r.doc_id, r.lang, r.lev + 1, r.pos // 8, sha256(s.a || r.cur || s.b), r.shown || s.a || s.b from rest r join upsib s on r.lev = s.lev and r.pos = s.pos),
done as (select doc_id, lang, arg_max(cur, lev) as folded_root, arg_max(shown, lev) as shown from rest group by doc_id, lang)
select l.doc_id, leaf, subroot, (select dig from up where n = 1) as root, sha256(shown) as proof_sha256, folded_root, folded_root = (select dig from up where n = 1) as verified
from done join l on done.doc_id is not distinct from l.doc_id and done.lang is not distinct from l.lang join subs on done.lang is not distinct from subs.lang"""


@query(MANIFEST_SQL)
def op11_merkle_manifest(spark, sf_dir):
    from dialogprep.llm import manifest

    said = [F.col(f) for f in manifest.FIELDS[:-1]] + [F.when(manifest.every_third(F.col("doc_id")), manifest.lowered(F.col("text"))).otherwise(F.col("text"))]
    found = manifest.manifest(documents(spark, sf_dir), claimed=said)
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


DIVERGENCE_SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
g as (select distinct lang, source from d),
w as (select r, lang, source, unnest(terms) as term from d),
c as (select lang, source, term, count(*) as n, count(distinct r) as docs from w group by all),
k as (select lang, term, sum(n)::bigint as total from c group by lang, term having sum(docs) >= 10),
v as (select lang, count(*) as v, sum(total)::bigint as n from k group by lang),
s as (select lang, source, sum(n)::bigint as n from c join k using (lang, term) group by lang, source),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.v))::bigint as p,
    (1 + (1000000000::hugeint * (k.total + 2)) // (v.n + 2 * v.v))::bigint as q
  from g join k using (lang) join v using (lang) left join s using (lang, source) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from p where n > 0 and p > q)
select *, (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
union all select * from (select *, (row_number() over (partition by lang, source order by value desc, item))::int as rank from terms) where rank <= 10"""


@query(DIVERGENCE_SQL)
def op12_source_divergence(spark, sf_dir):
    from dialogprep.llm import divergence

    return divergence.audited(documents(spark, sf_dir))
