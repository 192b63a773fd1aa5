"""WARC archives as a Spark data source in Python, and the round trip of a table of pages through it.

Reading plans one partition for each group of whole files, takes predicates on the record type and on header fields,
parses each record's headers first and seeks past (or, in compressed archives, inflates without keeping) the block of
a record that the predicates reject or whose payload is not asked for.
"""

from __future__ import annotations

import io
import json
import posixpath
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from filewright.llm.common import cut, filter_bits, new_path, small_batches, split_by

#: Column, header field that it holds.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, payload binary"
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_length long, payload binary"
MANIFEST = "_manifest.json"
_ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload_length", pa.int64()), ("payload", pa.binary())])
_DATE = "1970-01-01T00:00:00Z"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and plain path of a URI; an absolute path is a local one."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _field(value: str) -> str:
    """A header value: line breaks can't stand in one and are percent-encoded. Reading decodes nothing."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, record_id: str, uri: str | None, digest: str, refers_to: str | None, length: int, payload: bytes | None) -> bytes:
    """The bytes of one record: header lines, an HTTP response head, and for a response its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    body = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_field(uri)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; only those of tasks that commit enter the manifest.

    To append adds to the manifest, to overwrite replaces it; an archive has one writing job at a time.
    """

    def __init__(self, path: str, options: dict, overwrite: bool = False):
        self.overwrite = overwrite
        self.path, self.gzip = path, options.get("compression", "none") == "gzip"
        self.roll = int(options.get("fileBytes", 64 << 20))

    def write(self, iterator) -> _Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        out, name, size = None, "", 0
        try:
            for batch in iterator:
                for row in zip(*(batch.column(c).to_pylist() for c in ("record_type", "record_id", "target_uri", "payload_digest", "refers_to", "payload_length", "payload"))):
                    if out is None:
                        name, size = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip, 0
                        out = fs.open_output_stream(posixpath.join(root, name), compression=None)
                    data = record(*row)
                    if self.gzip:  # a member for each record
                        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                        data = packer.compress(data) + packer.flush()
                    out.write(data)
                    size += len(data)
                    if size >= self.roll:
                        out.close()
                        files.append((name, size))
                        out = None
        finally:
            if out is not None:
                out.close()
                files.append((name, size))
        return _Written(files)

    def commit(self, messages) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        at, files = posixpath.join(root, MANIFEST), []
        if not self.overwrite and fs.get_file_info(at).type == pafs.FileType.File:
            with fs.open_input_stream(at) as had:
                files = json.loads(had.read())
        files += [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(at) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else []:
                fs.delete_file(posixpath.join(root, name))


class _Blocks:
    """Reads an archive forward: lines, blocks, and skips that don't keep what they pass."""

    def __init__(self, stream, compressed: bool):
        self.raw = io.BufferedReader(_Inflated(stream), 1 << 16) if compressed else stream
        self.seeks = not compressed

    def line(self) -> bytes:
        return self.raw.readline()

    def block(self, n: int) -> bytes:
        return self.raw.read(n)

    def skip(self, n: int) -> None:
        if self.seeks:
            self.raw.seek(n, 1)
        else:
            while n > 0:
                n -= len(self.raw.read(min(n, 1 << 16))) or n


class _Inflated(io.RawIOBase):
    """The contents of concatenated gzip members."""

    def __init__(self, stream):
        self.stream, self.unpack, self.rest = stream, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            data = self.rest or self.stream.read(1 << 16)
            self.rest = b""
            if not data:
                return 0
            out = self.unpack.decompress(data, len(buffer))
            self.rest = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.rest = self.unpack.unused_data
                self.unpack = zlib.decompressobj(31)
            if out:
                buffer[: len(out)] = out
                return len(out)


class _Stream(io.RawIOBase):
    """A pyarrow file as a Python one that can seek, so that lines are read through a buffer."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset, whence=0):
        return self.file.seek(offset, whence)

    def tell(self):
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def records(stream, compressed: bool, wanted, payload: bool):
    """(header fields, payload length, payload or None) of each record that ``wanted`` accepts by its header."""
    source = _Blocks(stream if compressed else io.BufferedReader(_Stream(stream), 1 << 16), compressed)
    while True:
        line = source.line()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := source.line().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        left = int(head.get("content-length", 0))
        if not wanted(head):
            source.skip(left)
            continue
        length = None
        if head.get("content-type", "").startswith("application/http"):
            while left > 0:
                line = source.line()
                left -= len(line)
                if not line.strip():
                    break
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    length = int(value)
        body = None
        if payload and head.get("warc-type") != "revisit":
            body = source.block(left)
            length = len(body)
        else:
            source.skip(left)
            length = left if length is None else length
        yield head, length, body


@dataclass
class _Files(InputPartition):
    folder: str
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.payload = options.get("payload", "true").lower() != "false"
        self.target = int(options.get("partitionBytes", 32 << 20))
        self.allowed: dict[str, set] = {}

    def pushFilters(self, filters):
        """Takes equality, membership and presence of header columns; hands the rest back."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self._allow(column, {f.value})
            elif column in HEADERS and isinstance(f, In):
                self._allow(column, set(f.value))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.allowed.setdefault(column, None)
            else:
                yield f

    def _allow(self, column: str, values: set) -> None:
        had = self.allowed.get(column)
        self.allowed[column] = values if had is None else had & values

    def partitions(self):
        fs, root = _open(self.path)
        at, folder = posixpath.join(root, MANIFEST), self.path
        if fs.get_file_info(at).type == pafs.FileType.File:
            with fs.open_input_stream(at) as file:
                found = [(n, s) for n, s in json.loads(file.read())]
        elif fs.get_file_info(root).type == pafs.FileType.File:
            found, folder = [(posixpath.basename(root), fs.get_file_info(root).size)], self.path.rpartition("/")[0]
        else:
            listed = fs.get_file_info(pafs.FileSelector(root))
            found = [(i.base_name, i.size) for i in listed if i.base_name.endswith((".warc", ".warc.gz"))]
        groups, held = [], 0
        for name, size in sorted(found):
            if not groups or held + size > self.target:
                groups.append([])
                held = 0
            groups[-1].append(name)
            held += size
        return [_Files(folder, g) for g in groups] or [_Files(folder, [])]

    def _wanted(self, head: dict) -> bool:
        for column, values in self.allowed.items():
            value = _value(column, head)
            if value is None or values is not None and value not in values:
                return False
        return True

    def read(self, partition):
        fs, root = _open(partition.folder)
        rows, held = [], 0
        for name in partition.names:
            with fs.open_input_file(posixpath.join(root, name)) as stream:
                for head, length, body in records(stream, name.endswith(".gz"), self._wanted, self.payload):
                    rows.append((*(_value(c, head) for c in HEADERS), length, body))
                    held += len(body or b"") + 500
                    if held >= 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _value(column: str, head: dict) -> str | None:
    value = head.get(HEADERS[column].lower())
    if value is None:
        return None
    return value.strip("<>") if column in ("record_id", "refers_to") else value


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: payload (read: false leaves payloads out), partitionBytes (read), fileBytes and compression (write).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], dict(self.options))

    def writer(self, schema, overwrite) -> WarcWriter:
        return WarcWriter(self.options["path"], dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


#: Payloads that occur more than once, at most, of which each task gets the whole list: some 50 MB.
BROADCAST_COPIES = 200_000


def plan_records(pages: DataFrame, min_bytes: int = 100, broadcast_copies: int = BROADCAST_COPIES) -> DataFrame:
    """The record of each row of ``pages(page_id, url, html)``: its payload, digest and whether it revisits another.

    Of equal payloads of ``min_bytes`` at least, the smallest page_id is the response. The groups are found by
    partial aggregation of ids and digests (a payload that a third of all rows share becomes one row for each task)
    and joined back. A short list of groups, counted first, is broadcast and no payload moves. With a long one, a
    bitmap of its digests leaves payloads that occur once where they are; the others go through a sort-merge join,
    whose skewed parts AQE deals anew.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.length("payload").cast("long").alias("payload_length"), F.sha2("payload", 256).alias("payload_digest"))
    first = rows.where(F.col("payload_length") >= min_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    first = cut(first.select(F.col("payload_digest").alias("digest"), "first", F.xxhash64("payload_digest").alias("key")), "warc-copies")
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    if first.count() <= broadcast_copies:
        found = rows.join(F.broadcast(first.select("digest", "first")), F.col("payload_digest") == F.col("digest"), "left")
    else:
        maybe, never = split_by(rows.withColumn("key", F.xxhash64("payload_digest")), "key", first, "key", filter_bits(first.count()))
        listed = first.select("digest", "first").hint("shuffle_merge")
        found = maybe.join(listed, F.col("payload_digest") == F.col("digest"), "left").drop("digest").unionByName(never.withColumn("first", F.lit(None).cast("long")))
    return found.select(
        "page_id", "url", "payload_digest", "payload_length",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, min_bytes: int = 100, compression: str = "none") -> None:
    """Write the archives of ``pages`` under ``path``."""
    register(pages.sparkSession)
    small_batches(pages.sparkSession)
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    plan_records(pages, min_bytes).select(
        urn("page_id").alias("record_id"), "record_type", F.col("url").alias("target_uri"), "payload_digest",
        F.when(F.col("refers_to").isNotNull(), urn("refers_to")).alias("refers_to"), "payload_length", "payload",
    ).write.format("warc").option("compression", compression).mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Read archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The digest and size of a response are computed from the payload that was read; a revisit has them in its headers.
    """
    register(spark)
    number = lambda c: F.when(F.col(c) != "urn:page:null", F.regexp_extract(c, r"(-?\d+)$", 1).cast("long"))
    full = spark.read.format("warc").load(path).where("record_type = 'response'")
    full = full.select(number("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'")
    again = again.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))
    return full.unionByName(again)


def round_trip(pages: DataFrame, min_bytes: int = 100, compression: str = "none") -> DataFrame:
    """Write a record for each row of ``pages``, read the archives back and return what they say of each page.

    A null html is an empty payload, a null url leaves the field out, a page_id may be null (then no other record
    refers to it) and repeated rows stay repeated rows: of rows with the same least page_id and payload all are
    responses. An empty table gives an empty archive and no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_pages(pages, path, min_bytes, compression)
    return read_pages(spark, path)
