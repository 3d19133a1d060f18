"""WARC archives as a Spark data source, written and read by partitions.

``spark.dataSource.register(WarcSource)``, then ``format("warc")``. Every record is a gzip member of
its own whose header carries the member's length (the ``sl`` field of the WARC standard's gzip annex).

Writing: each task writes files of its own under new names and reports them with the offsets at
which stretches of ``segment_bytes`` begin; the commit lists them in ``_manifest.json``. Files of failed
or repeated attempts are in no manifest and are never read, so a lost executor costs a retry.

Reading: one partition per listed stretch, or per file where a folder has no manifest. Filters on
``record_type``, ``target_uri``, ``record_id`` and ``payload_digest`` are taken over: a member is
inflated only as far as its headers, and the rest is inflated only if the record is wanted and
``payload`` is not switched off (option ``payload=false``); the length field leads to the next member.
Filter push-down needs ``spark.sql.python.filterPushdown.enabled``.

Revisit records keep the HTTP headers of their response, and with them the payload's length.
Null payloads count as empty, null types as responses, null URIs are left out.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

MANIFEST = "_manifest.json"
FILE_BYTES = 1 << 30
SEGMENT_BYTES = 32 << 20
BATCH_RECORDS = 512
BATCH_BYTES = 8 << 20
_HEAD = 16_384

# fixed values: header names and texts of the format
_VERSION = b"WARC/1.1"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, payload_bytes long, payload binary"
_ARROW = pa.schema([*[(n, pa.string()) for n in _FIELDS], ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


# ---- records

def _line(text: str) -> str:
    """A header value: no line breaks."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(fields: dict, payload: bytes, payload_bytes: int) -> bytes:
    """One record, uncompressed. ``payload`` is left out of revisits."""
    revisit = fields.get("record_type") == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [_VERSION.decode(), *[f"{_FIELDS[n]}: {_line(fields[n])}" for n in _FIELDS if fields.get(n) is not None]]
    if revisit:
        head.append(f"WARC-Profile: {_PROFILE}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def member(raw: bytes, level: int = 1) -> bytes:
    """``raw`` as a gzip member that states its own length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff"
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return head + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _member_size(head: bytes) -> int | None:
    """The length that a member's header states."""
    if head[:4] != b"\x1f\x8b\x08\x04" or len(head) < 24 or head[12:14] != b"sl":
        return None
    return struct.unpack("<I", head[16:20])[0]


def parse_head(raw: bytes) -> tuple[dict, int, int] | None:
    """(header fields, payload length, where the payload begins); None if the headers are not complete yet."""
    stop = raw.find(_END)
    inner = raw.find(_END, stop + 4) if stop >= 0 else -1
    if inner < 0:
        return None
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw[:stop].decode().split("\r\n")[1:])}
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw[stop + 4 : inner].decode().split("\r\n")[1:])}
    block = int(headers["content-length"])
    size = int(http["content-length"]) if "content-length" in http else block - (inner - stop)
    return {n: headers.get(h.lower()) for n, h in _FIELDS.items()}, size, inner + 4


# ---- writing

@dataclass
class Written(WriterCommitMessage):
    segments: list


class WarcWriter(DataSourceArrowWriter):
    """Writes rows with the columns of ``SCHEMA``; missing columns count as null."""

    def __init__(self, path: str, overwrite: bool, options: dict):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.segment_bytes = int(options.get("segment_bytes", SEGMENT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        segments, out, at, began, name = [], None, 0, 0, ""

        def close():
            nonlocal out
            if out is not None:
                segments.append([name, began, at - began])
                out.close()
                out = None

        for batch in iterator:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                row = {n: columns[n][i].as_py() for n in columns}
                payload = row.get("payload") or b""
                payload = payload.encode() if isinstance(payload, str) else payload
                size = row.get("payload_bytes")
                row["record_type"] = row.get("record_type") or "response"
                data = member(record(row, payload, len(payload) if size is None else size))
                if out is None or at >= self.file_bytes:
                    close()
                    name, at, began = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                elif at - began >= self.segment_bytes:
                    segments.append([name, began, at - began])
                    began = at
                out.write(data)
                at += len(data)
        close()
        return Written(segments)

    def commit(self, messages: Sequence[Written | None]) -> None:
        store, root = _open(self.path)
        listed = [s for m in messages if m for s in m.segments]
        if not self.overwrite and store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as f:
                listed = json.loads(f.read()) + listed
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}.new") as f:
            f.write(json.dumps(listed).encode())
        store.move(f"{root}/{MANIFEST}.new", f"{root}/{MANIFEST}")

    def abort(self, messages: Sequence[Written | None]) -> None:
        store, root = _open(self.path)
        for name in {s[0] for m in messages if m for s in m.segments}:
            store.delete_file(f"{root}/{name}")


# ---- reading

@dataclass
class Segment(InputPartition):
    file: str
    first: int
    size: int


_COLUMNS = frozenset(("record_type", "target_uri", "record_id", "payload_digest"))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path, self.payload = path.rstrip("/"), str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in _COLUMNS and isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif column in _COLUMNS and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif column in _COLUMNS and isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[Segment]:
        store, root = _open(self.path)
        if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as f:
                listed = json.loads(f.read())
        else:
            files = store.get_file_info(fs.FileSelector(root)) if store.get_file_info(root).type == fs.FileType.Directory else [store.get_file_info(root)]
            root = root if store.get_file_info(root).type == fs.FileType.Directory else root.rpartition("/")[0]
            listed = [[f.base_name, 0, f.size] for f in files if f.type == fs.FileType.File and f.base_name.endswith((".warc.gz", ".warc"))]
        return [Segment(f"{root}/{name}", first, size) for name, first, size in listed]

    def _wanted(self, fields: dict) -> bool:
        for column, how, value in self.tests:
            own = fields[column]
            if own is None or not (own in value if how == "in" else own.startswith(value)):
                return False
        return True

    def read(self, partition: Segment | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where nothing is planned
            return
        rows, held = [], 0
        for row in self._records(partition):
            rows.append(row)
            held += len(row["payload"] or b"")
            if len(rows) >= BATCH_RECORDS or held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _records(self, part: Segment) -> Iterator[dict]:
        store, _ = _open(self.path)
        with store.open_input_file(part.file) as f:
            at, stop = part.first, part.first + part.size
            while at < stop:
                f.seek(at)
                compressed = f.read(min(4096, stop - at))
                size = _member_size(compressed)
                plain = compressed[:2] != b"\x1f\x8b"
                inflate = None if plain else zlib.decompressobj(31)
                raw = compressed if plain else inflate.decompress(compressed, _HEAD)
                fed = len(compressed)

                def more() -> bool:
                    """Inflate (or read) some more of this record."""
                    nonlocal raw, fed
                    if inflate is not None and inflate.eof:
                        return False
                    rest = inflate.unconsumed_tail if inflate is not None else b""
                    if not rest:
                        f.seek(at + fed)
                        rest = f.read(min(1 << 20, stop - at - fed))
                        fed += len(rest)
                    if not rest:
                        return False
                    raw += rest if inflate is None else inflate.decompress(rest, 1 << 20)
                    return True

                while (head := parse_head(raw)) is None and more():
                    pass
                if head is None:
                    raise ValueError(f"{part.file}: no record at {at}")
                fields, payload_bytes, begins = head
                wanted, payload = self._wanted(fields), None
                if wanted and self.payload and fields["record_type"] != "revisit":
                    while len(raw) < begins + payload_bytes and more():
                        pass
                    payload = raw[begins : begins + payload_bytes]
                if wanted:
                    yield {**fields, "payload_digest": (fields["payload_digest"] or "").removeprefix("sha1:") or None,
                           "payload_bytes": payload_bytes, "payload": payload}
                if size:
                    at += size
                elif plain:
                    stop_at = raw.find(_END) + 4 + int(dict((k.lower(), v) for k, _, v in (x.partition(": ") for x in raw[: raw.find(_END)].decode().split("\r\n")))["content-length"])
                    at += stop_at + len(_END)
                else:
                    while more():
                        raw = b""
                    at += fed - len(inflate.unused_data)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite, dict(self.options))


# ---- pages to archives and back

def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _base32(digest: F.Column) -> F.Column:
    """Base 32 of a SHA-1 in hex, 32 digits of five bits."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 2), 40, "0") for k in range(4)])
    digit = lambda k: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.conv(F.substring(bits, 1 + 5 * k, 5), 2, 10).cast("int") + 1, F.lit(1))
    return F.concat(*[digit(k) for k in range(32)])


def records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """A record per page, with the columns of ``SCHEMA``; equal payloads become revisits of the smallest id's.

    Payloads below ``least_bytes`` are always responses. Pages without an id are written without
    one and revisit a page that has one, if there is one. Rows of equal id and payload are all
    responses if theirs is the smallest id.
    """
    from dialogprep.session import durable

    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    keyed = pages.select(F.col(id).alias("_id"), F.col(url).alias("_url"), F.coalesce(html, F.lit("")).alias("_html"), F.sha1(body).alias("_sha"))
    narrow = durable(keyed.filter(F.octet_length("_html") >= least_bytes).select("_id", "_sha"), "digests")
    firsts = durable(narrow.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "firsts")
    later = narrow.join(firsts, "_sha").filter("_first is not null and (_id is null or _id > _first)").distinct()
    later = durable(later.select(F.col("_id").alias("_lid"), F.col("_sha").alias("_lsha"), "_first"), "revisits")
    all_ = keyed.join(later, F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_sha") == F.col("_lsha")), "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("_first").isNotNull()
    return all_.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name(F.col("_id")).alias("record_id"),
        F.col("_url").alias("target_uri"), F.lit("2000-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), _base32(F.col("_sha"))).alias("payload_digest"), F.when(revisit, name(F.col("_first"))).alias("refers_to"),
        F.octet_length("_html").cast("long").alias("payload_bytes"), F.when(~revisit, F.encode("_html", "UTF-8")).alias("payload"))


def page_of(record_id: F.Column) -> F.Column:
    """The page id in a record's name."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known, with filter push-down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write(pages: DataFrame, path: str, **options) -> None:
    """Write the pages' records below ``path``."""
    register(pages.sparkSession)
    records(pages, **options).write.format("warc").mode("overwrite").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
