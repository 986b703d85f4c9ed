"""WARC archives as a Python data source, and pages written to and read from them.

Written files hold one gzip member per record, with the skip lengths that the WARC standard's annex
on compression proposes: a reader learns from the first bytes of a member where the next one starts.
Reading plans one partition per file. Equality tests on the record type and on header columns are
pushed into the reader: it inflates the header of a record first, and inflates the rest only if the
record passes and a column of the requested schema needs the payload.

``spark.read.format("warc").schema(...).load(folder)`` takes any of these columns:

    page_id long, record_type, target_uri, record_id, refers_to_uri, payload_digest,
    refers_to long, payload_bytes long, payload binary, headers map<string,string>
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In,
                                    InputPartition, WriterCommitMessage)

from podium.llm.common import opened
from podium.session import scratch_dir

_TEXT, _LONG = T.StringType(), T.LongType()
SCHEMA = T.StructType([
    T.StructField("page_id", _LONG), T.StructField("record_type", _TEXT), T.StructField("target_uri", _TEXT),
    T.StructField("record_id", _TEXT), T.StructField("refers_to_uri", _TEXT), T.StructField("payload_digest", _TEXT),
    T.StructField("refers_to", _LONG), T.StructField("payload_bytes", _LONG), T.StructField("payload", T.BinaryType()),
    T.StructField("headers", T.MapType(_TEXT, _TEXT))])
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = {"record_type": "warc-type", "target_uri": "warc-target-uri", "record_id": "warc-record-id",
         "refers_to_uri": "warc-refers-to", "payload_digest": "warc-payload-digest"}
_MEMBER = struct.Struct("<4sIBBH2sHII")  # gzip header with one extra field: "sl", compressed and raw length
_CHUNK = 1 << 16


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    """Stable id of a page's record; a page without id gets one by chance."""
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def encoded(row) -> bytes:
    """One record: WARC header, then the HTTP header, then the payload unless it is a revisit."""
    payload = bytes(row["payload"] or b"")
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % row["payload_bytes"])
    block = http if row["record_type"] == "revisit" else http + payload
    uri = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_uri(row["page_id"])),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
              ("Content-Type", "application/http; msgtype=response"), ("X-Payload-Length", str(row["payload_bytes"]))]
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(row["refers_to"])),
                   ("X-Refers-To-Page", str(row["refers_to"]))]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record as a gzip member that names its own length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = _MEMBER.size + len(body) + 8
    head = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class Inflater:
    """A record's bytes, inflated only as far as they are asked for."""

    def __init__(self, stream, start: int):
        self.stream, self.start = stream, start
        stream.seek(start)
        head = stream.read(_MEMBER.size)
        self.length = None
        if head[:4] == b"\x1f\x8b\x08\x04" and head[12:14] == b"sl":
            self.length = _MEMBER.unpack(head)[7]
        self.inflate = zlib.decompressobj(31)
        self.fed, self.data = head, b""

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        raw = self.fed or self.stream.read(_CHUNK)
        self.fed = b""
        if not raw:
            raise ValueError(f"record at {self.start} is cut off")
        self.data += self.inflate.decompress(raw)
        return True

    def until(self, mark: bytes) -> int:
        while (at := self.data.find(mark)) < 0:
            if not self.more():
                raise ValueError(f"record at {self.start} has no header")
        return at + len(mark)

    def upto(self, size: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < size and not self.inflate.eof:
            self.data = b""
            self.more()
            parts.append(self.data)
            have += len(self.data)
        self.data = b"".join(parts)
        return self.data[:size]

    def end(self) -> int:
        """Where the next member starts; found without inflating if this one names its length."""
        if self.length is not None:
            return self.start + self.length
        while not self.inflate.eof:
            self.data = b""
            self.more()
        return self.stream.tell() - len(self.inflate.unused_data)


@dataclass
class FilePartition(InputPartition):
    path: str
    size: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.columns = path, schema.names
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps equality and list tests on header columns, hands the rest back to Spark."""
        for test in filters:
            name = test.attribute[0] if getattr(test, "attribute", None) and len(test.attribute) == 1 else None
            if name in NAMES and isinstance(test, EqualTo):
                self.wanted.append((name, frozenset([test.value])))
            elif name in NAMES and isinstance(test, In):
                self.wanted.append((name, frozenset(test.value)))
            else:
                yield test

    def partitions(self) -> list[FilePartition]:
        from pyarrow import fs
        system, path = opened(self.path)
        files = system.get_file_info(fs.FileSelector(path, recursive=False))
        return [FilePartition(f.path, f.size) for f in sorted(files, key=lambda f: f.path)
                if f.is_file and f.base_name.endswith(".warc.gz")]

    def read(self, partition: FilePartition | None) -> Iterator[tuple]:
        if partition is None:  # a folder without archives
            return
        system, _ = opened(self.path)
        with system.open_input_file(partition.path) as stream:
            at = 0
            while at < partition.size:
                record = Inflater(stream, at)
                row = self._row(record)
                at = record.end()
                if row is not None:
                    yield row

    def _row(self, record: Inflater) -> tuple | None:
        body = record.until(b"\r\n\r\n")
        head = record.data[:body - 4].decode("utf-8", "replace").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {record.start}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head[1:])}
        values = {name: headers.get(field) for name, field in NAMES.items()}
        values["payload_digest"] = (values["payload_digest"] or "").partition(":")[2] or None
        if any(values[name] not in allowed for name, allowed in self.wanted):
            return None
        number = {"page_id": "x-page-id", "refers_to": "x-refers-to-page", "payload_bytes": "x-payload-length"}
        values |= {name: int(headers[field]) if field in headers else None for name, field in number.items()}
        values["headers"] = headers
        if "payload" in self.columns:
            block = record.upto(body + int(headers.get("content-length", 0)))[body:]
            is_http = headers.get("content-type", "").startswith("application/http")
            values["payload"] = block.partition(b"\r\n\r\n")[2] if is_http else block
        return tuple(values[name] for name in self.columns)


@dataclass
class Written(WriterCommitMessage):
    draft: str | None
    final: str | None


class WarcWriter(DataSourceWriter):
    """One file per task under a name of its attempt; the commit puts the winners in place."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        draft = final = stream = None
        for row in rows:
            if stream is None:
                part = TaskContext.get().partitionId()
                draft, final = f"{folder}/.draft-{part:05d}-{uuid.uuid4().hex}", f"{folder}/part-{part:05d}.warc.gz"
                stream = system.open_output_stream(draft)
            stream.write(member(encoded(row.asDict())))
        if stream is not None:
            stream.close()
        return Written(draft, final)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        for message in messages:
            if message and message.draft:
                system.move(message.draft, message.final)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = opened(self.path)
        for message in messages:
            if message and message.draft:
                system.delete_file(message.draft)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        unknown = set(schema.names) - set(SCHEMA.names)
        if unknown:
            raise ValueError(f"no such column in an archive: {sorted(unknown)}")
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows to write: payload, digest and, for a copy of an earlier page, the page it refers to.

    Of equal payloads of ``least_bytes`` or more, the one with the smallest page id is the response
    and the others revisit it. A null html is an empty payload. A page without id is always a response
    of its own, and of rows that repeat the smallest id all are. Groups are counted by digest alone and
    partly in the map tasks, so a payload that a third of all pages hold costs no more than any other.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"),
                        F.length(payload).cast("long").alias("payload_bytes"))
    first = (rows.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("sha1", "first"))
    revisits = (F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first"))
                & (F.col("payload_bytes") >= least_bytes))
    digest = F.udf(lambda h: base64.b32encode(bytes.fromhex(h)).decode(), "string")
    return (rows.join(first, "sha1", "left").withColumn("again", F.coalesce(revisits, F.lit(False)))
            .select("page_id", "url", F.when(~F.col("again"), F.col("payload")).alias("payload"),
                    F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
                    digest("sha1").alias("payload_digest"),
                    F.when(F.col("again"), F.col("first")).alias("refers_to"), "payload_bytes"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record per page to archives in ``path``. No pages: a folder without archives."""
    register(pages.sparkSession)
    records(pages, least_bytes).write.format("warc").mode("append").save(path)


def register(spark: SparkSession) -> None:
    """Make the format known to a session; Spark asks for its filter push-down to be switched on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """Archives of a folder; ``columns`` is a DDL list of those wanted, payloads are costly."""
    register(spark)
    reader = spark.read.format("warc")
    return (reader.schema(columns) if columns else reader).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages and describe every one of them by what the archives hold.

    Bytes and digest of a response come from its payload as read back, those of a revisit from its
    header. Columns: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``target_uri``. Extra columns of ``pages`` are not archived.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_warc(pages, path, least_bytes)
    digest = F.udf(lambda data: digest_of(bytes(data)), "string")
    responses = (read_warc(spark, path, "page_id bigint, record_type string, target_uri string, payload binary")
                 .filter("record_type = 'response'")
                 .select("page_id", F.length("payload").cast("long").alias("payload_bytes"),
                         digest("payload").alias("payload_digest"), "record_type",
                         F.lit(None).cast("bigint").alias("refers_to"), "target_uri"))
    revisits = (read_warc(spark, path, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                       "record_type string, refers_to bigint, target_uri string")
                .filter("record_type = 'revisit'"))
    return responses.unionByName(revisits)
