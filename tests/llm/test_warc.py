import base64
import gzip
import hashlib
import json
import os

from pyspark.sql import functions as F

from dialogprep.llm import warc

ROWS = [(1, "http://a/1", "<p>one é</p>"), (2, "http://a/2\n", "<p>two</p>"), (3, "http://b/3", "<p>one é</p>"), (4, None, None), (5, "http://b/5", ""), (None, "http://c", "<p>two</p>"),
        (6, "http://b/6", "x" * 200_000), (2, "http://a/2\n", "<p>two</p>"), (None, "http://d", "only without id"), (7, "http://a/7", "WARC/1.1\r\n\r\nfake")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write(pages(spark), path)
    got = warc.read(spark, path).withColumns({"page": warc.page_of(F.col("record_id")), "first": warc.page_of(F.col("refers_to"))}).collect()
    assert len(got) == len(ROWS)
    by = {}
    for i, url, body in ROWS:
        raw = (body or "").encode()
        by.setdefault(raw, []).append(i)
    for r in got:
        raw = next(b for b in by if base64.b32encode(hashlib.sha1(b).digest()).decode() == r.payload_digest)
        ids = [i for i in by[raw] if i is not None]
        first = min(ids) if ids else None
        revisit = first is not None and r.page != first
        assert (r.record_type, r.first, r.payload_bytes) == ("revisit" if revisit else "response", first if revisit else None, len(raw))
        assert r.payload == (None if revisit else raw)
    assert {r.target_uri for r in got} == {(u or "").replace("\n", "%0A") or None for _, u, _ in ROWS}


def test_files_are_plain_gzip_and_only_listed_ones_are_read(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write(pages(spark), path)
    names = [n for n in os.listdir(path) if n.endswith(".warc.gz")]
    raw = b"".join(gzip.open(f"{path}/{n}").read() for n in names)
    assert raw.count(b"WARC-Type: ") == len(ROWS) and "<p>one é</p>".encode() in raw
    listed = json.load(open(f"{path}/{warc.MANIFEST}"))
    assert {n for n, _, _ in listed} == set(names)
    (tmp_path / "out" / "left-behind.warc.gz").write_bytes(warc.member(warc.record({"record_type": "response"}, b"x", 1)))
    assert warc.read(spark, path).count() == len(ROWS)
    # without a manifest every archive counts, members without a length field too
    os.makedirs(tmp_path / "bare")
    (tmp_path / "bare" / "a.warc.gz").write_bytes(b"".join(gzip.compress(warc.record({"record_type": "response", "target_uri": str(k)}, b"y" * k * 9000, k * 9000)) for k in range(4)))
    (tmp_path / "bare" / "b.warc").write_bytes(b"".join(warc.record({"record_type": "response", "target_uri": f"p{k}"}, b"z" * k, k) for k in range(3)))
    for payload in (True, False):
        got = warc.read(spark, str(tmp_path / "bare"), payload).collect()
        assert sorted((r.target_uri, r.payload_bytes) for r in got) == [("0", 0), ("1", 9000), ("2", 18000), ("3", 27000), ("p0", 0), ("p1", 1), ("p2", 2)]
        assert all((r.payload is None) != payload for r in got)


def test_filters_are_pushed_down(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write(pages(spark), path)
    reader = warc.WarcReader(path, {})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_bytes",), 3), In(("record_id",), ("<urn:page:1>", "<urn:page:2>")), StringStartsWith(("target_uri",), "http://a")]))
    assert rest == [GreaterThan(("payload_bytes",), 3)] and len(reader.tests) == 3
    found = warc.read(spark, path).filter("record_type = 'response' and target_uri like 'http://a%' and payload_bytes > 8")
    assert sorted(warc_id for warc_id, in found.select("record_id").collect()) == ["<urn:page:1>", "<urn:page:2>", "<urn:page:2>", "<urn:page:7>"]


def test_stretches_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.dataSource.register(warc.WarcSource)
    warc.records(pages(spark, [(k, f"u{k}", f"text {k}") for k in range(50)])).coalesce(1).write.format("warc").option("segment_bytes", 1000).option("file_bytes", 4000).mode("overwrite").save(path)
    reader = warc.WarcReader(path, {})
    parts = reader.partitions()
    assert len(parts) > 10 and len({p.file for p in parts}) > 1
    assert warc.read(spark, path).select("record_id").distinct().count() == 50
    warc.write(pages(spark).limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
