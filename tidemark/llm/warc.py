"""WARC archives as a Python data source, with reader and writer.

Partitions are planned by file and, in files whose members carry their lengths,
by range of members. Header predicates are pushed down: a record's headers are
parsed first, and the payload of an unwanted record is skipped, unread where its
compressed length is known. A schema without `payload` reads no payload at all.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from tidemark.llm.common import ship
from tidemark.session import materialize, shared_root

# Field names and the revisit profile of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, content_type string, payload_length bigint, payload binary"
)
LEVEL = 1
# A file is closed beyond so many bytes; a partition reads about as many.
FILE_BYTES = 64 << 20
PART_BYTES = 16 << 20
BATCH_BYTES = 8 << 20
MANIFEST = "_manifest.json"


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member that says its own length: extra field "sl" holds the
    compressed and the plain length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    # Gzip magic, deflate, flag for extra fields, time 0, system unknown.
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sH", 12, b"sl", 8)
    total = len(head) + 8 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return head + struct.pack("<II", total, len(data) & 0xFFFFFFFF) + body + tail


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [VERSION]
    for name, value in fields.items():
        if value is not None:
            clean = value.replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{name}: {clean}".encode())
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_head(content_type: str, length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {length}\r\n\r\n".encode()


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows with the columns of SCHEMA to archives; each attempt has files of its
    own, and the manifest names those of the attempts that count."""

    def __init__(self, path: str, columns: list[str], overwrite: bool, file_bytes: int):
        self.path, self.columns, self.overwrite, self.file_bytes = path, columns, overwrite, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = store(self.path)
        fs.create_dir(root, recursive=True)
        files, out, name = [], None, None
        marks: list[int] = []
        size = 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                files.append({"name": name, "bytes": size, "marks": marks})
                out = None

        for batch in iterator:
            rows = {c: batch.column(c) for c in self.columns}
            for i in range(batch.num_rows):
                if out is None:
                    name, size, marks = f"part-{uuid.uuid4().hex}.warc.gz", 0, []
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    size += out.write(member(record({"WARC-Type": "warcinfo"}, b"format: WARC File Format 1.1\r\n")))
                    marks = [0]
                row = {c: rows[c][i].as_py() for c in self.columns}
                raw = member(self._record(row))
                if size - marks[-1] >= PART_BYTES:
                    marks.append(size)
                out.write(raw)
                size += len(raw)
                if size >= self.file_bytes:
                    close()
        close()
        return Written(files)

    @staticmethod
    def _record(row: dict) -> bytes:
        kind = row.get("content_type") or "text/html; charset=utf-8"
        payload = row.get("payload") or b""
        length = row.get("payload_length")
        length = len(payload) if length is None else length
        block = http_head(kind, length)
        revisit = row.get("record_type") == "revisit"
        fields = {
            "WARC-Type": row.get("record_type") or "response",
            "WARC-Record-ID": row.get("record_id"),
            "WARC-Date": row.get("date"),
            "WARC-Target-URI": row.get("target_uri"),
            "WARC-Refers-To": row.get("refers_to"),
            "WARC-Profile": PROFILE if revisit else None,
            "WARC-Payload-Digest": row.get("payload_digest"),
            "Content-Type": "application/http; msgtype=response",
        }
        return record(fields, block if revisit else block + payload)

    def commit(self, messages) -> None:
        fs, root = store(self.path)
        fs.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            files = manifest(fs, root) + files
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        """Files of failed attempts are in no manifest, so no reader sees them."""


def manifest(fs: pyarrow.fs.FileSystem, root: str) -> list[dict]:
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pyarrow.fs.FileType.NotFound:
        return []
    with fs.open_input_stream(f"{root}/{MANIFEST}") as file:
        return json.loads(file.read())


@dataclass
class Part(InputPartition):
    path: str
    first: int
    last: int | None

    def __init__(self, path: str, first: int, last: int | None):
        super().__init__((path, first, last))
        self.path, self.first, self.last = path, first, last


def _test(f):
    """A predicate on a record's columns for a pushed filter, or None."""
    name = f.attribute[0] if len(f.attribute) == 1 else None
    if name not in FIELDS and name != "payload_length":
        return None
    if isinstance(f, IsNotNull):
        return lambda r: r[name] is not None
    if isinstance(f, IsNull):
        return lambda r: r[name] is None
    if isinstance(f, In):
        wanted = set(f.value)
        return lambda r: r[name] in wanted
    # What each kind of filter asks of a value that is there.
    tests = {
        EqualTo: lambda a, b: a == b,
        GreaterThan: lambda a, b: a > b,
        GreaterThanOrEqual: lambda a, b: a >= b,
        LessThan: lambda a, b: a < b,
        LessThanOrEqual: lambda a, b: a <= b,
        StringStartsWith: lambda a, b: a.startswith(b),
        StringEndsWith: lambda a, b: a.endswith(b),
        StringContains: lambda a, b: b in a,
    }
    test = tests.get(type(f))
    if test is None or f.value is None:
        return None
    return lambda r: r[name] is not None and test(r[name], f.value)


class Window:
    """A part of a file that is read ahead in blocks and can be skipped over."""

    def __init__(self, file, at: int, last: int | None, block: int = 1 << 20):
        self.file, self.at, self.block = file, at, block
        self.last = file.size() if last is None else last
        self.held, self.base = b"", at

    def take(self, n: int) -> bytes:
        """Up to n bytes from here; the place does not move."""
        if self.base <= self.at and self.at + n <= self.base + len(self.held):
            return self.held[self.at - self.base : self.at - self.base + n]
        self.file.seek(self.at)
        self.held, self.base = self.file.read(max(n, self.block)), self.at
        return self.held[:n]


def _complete(head: bytes) -> bool:
    """Whether all headers are there: the record's and, in its block, those of HTTP."""
    at = head.find(b"\r\n\r\n")
    if at < 0:
        return False
    block = head[at + 4 :]
    if len(block) >= int(parse_head(head).get("content-length", 0)):
        return True
    return b"\r\n\r\n" in block if block[:5] == b"HTTP/"[: len(block)] else True


def _inflate(window: Window, start: int, known: int | None, want) -> tuple[bytes, bytes | None, int]:
    """(head, rest, next place) of a member whose deflate stream starts at `start`.

    Only the head is inflated at first; the rest only where `want(head)`. With
    a known length the member is then stepped over, else it is inflated to find
    its end and what comes out is dropped.
    """
    decoder = zlib.decompressobj(-15)
    place = window.at + start
    head, feed = b"", b""
    while not _complete(head) and not decoder.eof:
        feed = decoder.unconsumed_tail
        if not feed:
            here, window.at = window.at, place
            feed = window.take(4096)
            window.at = here
            place += len(feed)
            if not feed:
                break
        head += decoder.decompress(feed, 4096)
    wanted = want(head)
    if not wanted and known is not None:
        return head, None, window.at + known
    parts = [head]
    while not decoder.eof:
        feed = decoder.unconsumed_tail
        if not feed:
            here, window.at = window.at, place
            feed = window.take(1 << 16)
            window.at = here
            place += len(feed)
            if not feed:
                break
        out = decoder.decompress(feed, 1 << 18)
        if wanted:
            parts.append(out)
    end = place - len(decoder.unused_data) + 8
    return head, b"".join(parts) if wanted else None, window.at + known if known is not None else end


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n\r\n", 1)[0].split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    out = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().decode().lower()] = value.strip().decode("utf-8", "replace")
    return out


def _columns(head: bytes) -> dict:
    """Header columns of a record; the payload's length is that of its HTTP head."""
    known = parse_head(head)
    row = {c: known.get(name.lower()) for c, name in FIELDS.items()}
    row["payload_length"] = None
    block = head.split(b"\r\n\r\n", 1)[1] if b"\r\n\r\n" in head else b""
    row["_length"] = int(known.get("content-length", 0))
    if block.startswith(b"HTTP/"):
        for line in block.split(b"\r\n\r\n", 1)[0].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                row["payload_length"] = int(value)
            elif name.strip().lower() == b"content-type":
                row["content_type"] = value.strip().decode("utf-8", "replace")
    return row


def _payload(whole: bytes, row: dict) -> bytes:
    block = whole.split(b"\r\n\r\n", 1)[1][: row["_length"]]
    return block.split(b"\r\n\r\n", 1)[1] if block.startswith(b"HTTP/") else block


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.names = path, schema.names
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if hasattr(f, "attribute") and _test(f) is not None:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Part]:
        """Files of the manifest cut at its marks; any other folder or file as it is."""
        fs, root = store(self.path)
        if fs.get_file_info(root).type == pyarrow.fs.FileType.File:
            return [Part(root, 0, None)]
        parts = []
        if fs.get_file_info(f"{root}/{MANIFEST}").type != pyarrow.fs.FileType.NotFound:
            for file in manifest(fs, root):
                stops = [*file["marks"][1:], file["bytes"]]
                parts += [Part(f"{root}/{file['name']}", a, b) for a, b in zip(file["marks"], stops)]
        elif fs.get_file_info(root).type == pyarrow.fs.FileType.Directory:
            for info in fs.get_file_info(pyarrow.fs.FileSelector(root)):
                if info.base_name.endswith((".warc", ".warc.gz")):
                    parts.append(Part(info.path, 0, None))
        return parts

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where there are no partitions
            return
        fs, _ = store(self.path)
        tests = [_test(f) for f in self.filters]
        with_payload = "payload" in self.names
        rows, held = [], 0
        with fs.open_input_file(partition.path) as file:
            window = Window(file, partition.first, partition.last)
            while window.at < window.last:
                row = self._next(window, tests, with_payload)
                if row is not None:
                    rows.append(row)
                    held += 256 + len(row.get("payload") or b"")
                    if held >= BATCH_BYTES:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_length": pa.int64()}
        columns = [pa.array([r.get(c) for r in rows], kinds.get(c, pa.string())) for c in self.names]
        return pa.RecordBatch.from_arrays(columns, names=self.names)

    def _next(self, window: Window, tests: list, with_payload: bool) -> dict | None:
        """The next record's row, or None for one that the filters reject."""
        found: dict = {}

        def want(head: bytes) -> bool:
            # HTTP headers come in the first bytes of the block.
            found.update(_columns(head))
            found["_ok"] = all(t(found) for t in tests)
            return found["_ok"] and with_payload

        head = window.take(22)
        if head.startswith(b"\x1f\x8b"):
            start, known = 10, None
            flags = head[3]
            if flags & 4:
                extra = struct.unpack_from("<H", head, 10)[0]
                start = 12 + extra
                if head[12:14] == b"sl" and len(head) >= 20:
                    known = struct.unpack_from("<I", head, 16)[0]
            for flag in (8, 16):
                if flags & flag:
                    start += window.take(start + 4096)[start:].index(b"\0") + 1
            start += 2 if flags & 2 else 0
            _, whole, end = _inflate(window, start, known, want)
        else:
            size = 4096
            while b"\r\n\r\n" not in (text := window.take(size)) and len(text) == size:
                size *= 2
            at = text.index(b"\r\n\r\n") + 4
            length = int(parse_head(text).get("content-length", 0))
            head = window.take(at + min(length, 4096))
            while not _complete(head):
                head = window.take(at + min(length, 2 * len(head)))
            whole = window.take(at + length) if want(head) else None
            end = window.at + at + length + 4
        window.at = end
        if not found["_ok"]:
            return None
        if with_payload:
            found["payload"] = _payload(whole, found)
        return found


class WarcSource(DataSource):
    """format("warc"): option path is a folder or a file."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        size = int(self.options.get("file_bytes", FILE_BYTES))
        return WarcWriter(self.options["path"], schema.names, overwrite, size)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).option("path", path).load()


def write_warc(df: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    register(df.sparkSession)
    writer = df.write.format("warc").mode("overwrite").option("file_bytes", str(file_bytes))
    writer.option("path", path).save()


# Fixed values of the contract: how ids are written, and the least payload that is revisited.
ID = "urn:page:"
LEAST = 100
DATE = "1970-01-01T00:00:00Z"


def page_records(pages: DataFrame) -> DataFrame:
    """Records for pages: equal payloads of LEAST bytes or more are written once.

    Digests alone decide which page a payload stays with; the pages are joined
    with that answer by id, so a payload that many share gathers nowhere.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    given = pages.select("page_id", "url", payload.alias("payload"))
    given = given.withColumns({"_digest": F.sha2("payload", 256), "_size": F.octet_length("payload").cast("long")})
    known = materialize(given.select("page_id", "_digest", "_size"), "payloads")
    large = known.filter(F.col("_size") >= LEAST)
    first = large.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    again = large.join(first.filter("_n > 1"), "_digest").filter(F.col("page_id") != F.col("_first"))
    again = materialize(again.select("page_id", "_digest", "_first").distinct(), "revisits")
    uri = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("_first").isNotNull()
    return given.join(again, ["page_id", "_digest"], "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        uri(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.when(revisit, uri(F.col("_first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "_digest").alias("payload_digest"),
        F.col("_size").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write a record per page and read the archives back, one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to. A response's
    length and digest are those of the payload that was read; a revisit has
    them in its headers. Null html is the empty payload, a null url has no
    header; a page without id is always a response; repeated rows are records
    each, the first payload's page being a response in all of them. Other
    columns are ignored; an empty table gives no archives and no rows.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    path = path or f"{shared_root(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(page_records(pages), path)
    found = read_warc(spark, path).filter(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.nullif(F.regexp_extract(c, f"^<{ID}(.*)>$", 1), F.lit("")).cast(kind)
    whole = F.col("record_type") == "response"
    return found.select(
        number("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to"),
    )
