"""WARC archives: one gzip member per record, written and read back as a sequence.

``write_archives`` lets every task write its rows to archive files of bounded size in a
shared folder and returns the manifest: one row per archive of a successful task, so
files that a lost attempt left behind are never read. Rows with equal payloads of at
least ``least_bytes`` bytes become one response (that of the smallest id) and revisits
of it; which rows those are is settled on ids and digests alone, so payloads are not
shuffled by digest and a payload shared by a third of all rows meets no single task.

``read_archives`` deals archives to tasks. Each is read from its start in blocks of
``READ_BYTES``: a member is decompressed incrementally (zlib), its record framed by
Content-Length, and the block and payload digests verified as the bytes pass. A record
that is cut short, is longer than its frame, misses its end, has a head that can't be
read or fails a digest raises ``WarcError`` with the archive's name and the member's
number. An archive must hold the records and bytes that the manifest states, and every
revisit must name a response of the manifest's archives with its digest: nothing is
skipped.

Archives are plain files of gzip members, as other readers of the format expect; their
storage compresses nothing once more. Tasks open them with Arrow's file systems: local
and shared folders, ``s3://`` (``s3a://`` is taken as it) and ``hdfs://`` where libhdfs
is installed on the executors.

Null payloads are empty. Null ids are written without an id and come back null; they
are never the response that others revisit. Rows with equal ids and payloads are all
responses if that id is the smallest, else all revisits. Urls may be null, and control
characters and spaces in them are percent-encoded. Other input columns are ignored. An
empty table gives no archive and no record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepare, written
from cadence.session import scratch_path

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that breaks the format or a digest."""


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None,
           date: str = DATE) -> bytes:
    """One record, uncompressed. Revisits hold the HTTP head only; their payload's
    length and digest stand in the record's head."""
    kind = "revisit" if refers_to is not None else "response"
    block = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()]
    if kind == "response":
        block.append(payload)
    sha = hashlib.sha256()
    for part in block:
        sha.update(part)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page}:{digest}")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {quote(url or 'urn:none', safe=':/?#[]@!$&()*+,;=%~')}"]
    if page is not None:
        head.append(f"Page-Id: {quote(page)}")
    if refers_to is not None:
        target = uuid.uuid5(uuid.NAMESPACE_URL, f"{refers_to}:{digest}")
        head += [f"WARC-Refers-To: <urn:uuid:{target}>", f"Refers-To-Page-Id: {quote(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}",
             f"WARC-Block-Digest: sha256:{sha.hexdigest()}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {sum(map(len, block))}"]
    return b"".join(["\r\n".join(head).encode(), b"\r\n\r\n", *block, b"\r\n\r\n"])


def member(data: bytes, level: int = LEVEL) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _head(raw: bytes) -> dict[str, str]:
    try:
        lines = raw.decode().split("\r\n")
    except UnicodeDecodeError:
        raise WarcError("the head is not UTF-8") from None
    if not lines[0].startswith("WARC/1."):
        raise WarcError(f"no WARC version: {lines[0][:40]!r}")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not head.get("warc-type"):
        raise WarcError("no WARC-Type")
    return head


def _number(head: dict[str, str], name: str) -> int:
    value = head.get(name.lower(), "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"no {name}")
    return int(value)


def _id(value: str | None) -> str | None:
    return None if value is None else unquote(value)


class _Record:
    """State of the record that the member being read holds."""

    def __init__(self, with_payload: bool):
        self.head: dict[str, str] | None = None
        self.pending = bytearray()
        self.with_payload = with_payload
        self.payload = bytearray()
        self.payload_bytes = 0
        self.block_sha, self.payload_sha = hashlib.sha256(), hashlib.sha256()
        self.left, self.tail, self.in_payload = 0, bytearray(), False

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.pending += data
            at = self.pending.find(b"\r\n\r\n")
            if at < 0:
                return
            self.head = _head(bytes(self.pending[:at]))
            self.left = _number(self.head, "Content-Length")
            data = bytes(self.pending[at + 4:])
            self.pending.clear()
        block, rest = data[:self.left], data[self.left:]
        self.left -= len(block)
        self.tail += rest
        if len(self.tail) > 4:
            raise WarcError("bytes after the record")
        if not block:
            return
        self.block_sha.update(block)
        if self.head["warc-type"] != "response":
            return
        if not self.in_payload:
            self.pending += block
            at = self.pending.find(b"\r\n\r\n")
            if at < 0:
                return
            block, self.in_payload = bytes(self.pending[at + 4:]), True
            self.pending.clear()
        self.payload_sha.update(block)
        self.payload_bytes += len(block)
        if self.with_payload:
            self.payload += block

    def close(self) -> dict:
        if self.head is None or self.left or self.tail != b"\r\n\r\n":
            raise WarcError("record cut short")
        h = self.head
        if h.get("warc-block-digest") != f"sha256:{self.block_sha.hexdigest()}":
            raise WarcError("block digest differs")
        digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
        if h["warc-type"] == "response":
            if digest != self.payload_sha.hexdigest():
                raise WarcError("payload digest differs")
            length = self.payload_bytes
        else:
            length = _number(h, "Payload-Length")
        return {"record_id": h.get("warc-record-id"), "record_type": h["warc-type"], "page_id": _id(h.get("page-id")),
                "url": h.get("warc-target-uri"), "payload_bytes": length, "payload_digest": digest,
                "refers_to": _id(h.get("refers-to-page-id")), "refers_to_record": h.get("warc-refers-to"), "payload": bytes(self.payload) if self.with_payload else None}


class _Counted:
    """A stream that counts the bytes read."""

    def __init__(self, stream):
        self.stream, self.bytes = stream, 0

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.bytes += len(data)
        return data


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def read_records(stream, name: str = "", with_payload: bool = False, block: int = READ_BYTES) -> Iterator[dict]:
    """Records of one archive in order; ``stream`` has ``read(n)``."""
    data, number = stream.read(block), 0
    while data:
        number += 1
        expand, rec = zlib.decompressobj(31), _Record(with_payload)
        try:
            while not expand.eof:
                if not data:
                    raise WarcError("gzip member cut short")
                rec.feed(expand.decompress(data, block * 4))
                data = expand.unconsumed_tail or expand.unused_data or (b"" if expand.eof else stream.read(block))
            data = data or stream.read(block)
            made = rec.close()
        except (WarcError, zlib.error) as e:
            raise WarcError(f"{name}, member {number}: {e}") from None
        yield made


def revisits(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(id, digest, refers_to) of the rows that revisit another; without payloads."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    light = pages.select(F.col(id_col).alias("__id"), F.sha2(payload, 256).alias("__digest"),
                         F.octet_length(payload).alias("__bytes")).filter(F.col("__bytes") >= least_bytes)
    light = written(light.select("__id", "__digest"), "digests")
    first = light.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n")).filter(
        "__n > 1 and __first is not null").drop("__n")
    return light.join(first, "__digest").filter(~F.col("__id").eqNullSafe(F.col("__first"))).select(
        "__id", "__digest", F.col("__first").cast("string").alias("__refers_to")).distinct()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes every row as a record below ``folder`` (a URI that all executors share)
    and returns the manifest: path, records, bytes."""
    spark = pages.sparkSession
    prepare(spark)
    again = revisits(pages, id_col, payload_col, least_bytes)
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("__i"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    rows = rows.join(again, rows["__i"].eqNullSafe(again["__id"]) & (rows["digest"] == again["__digest"]), "left").select(
        F.col("__i").cast("string").alias("page"), "url", "payload", "digest", F.col("__refers_to").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        done, out, path, records, size = [], None, "", 0, 0
        for batch in batches:
            for row in zip(*(c for c in batch.columns)):
                page, url, payload, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, out, records, size = f"{folder}/{name}", store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                data = member(record(page, url, payload.encode(), digest, refers_to))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        paths, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                                         names=["path", "records", "bytes"])

    return written(rows.mapInArrow(write, "path string, records bigint, bytes bigint"), "manifest")


RECORD_DDL = ("record_id string, record_type string, page_id string, url string, payload_bytes bigint, "
              "payload_digest string, refers_to string, refers_to_record string, payload binary")


def read_archive(path: str, records: int, size: int, with_payload: bool = False) -> Iterator[dict]:
    """Records of one archive, which must hold as many records and bytes as stated."""
    store, at = _store(path)
    n = 0
    with store.open_input_stream(at, compression=None) as raw:
        stream = _Counted(raw)
        for n, r in enumerate(read_records(stream, path, with_payload), 1):
            yield r
    if n != records or stream.bytes != size:
        raise WarcError(f"{path}: {n} records in {stream.bytes} bytes, the manifest has {records} in {size}")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of all archives of a manifest (columns of ``RECORD_DDL``; payload
    null unless asked for), read once into a table. The number of archives reaches the
    driver."""
    n = max(1, manifest.count())
    text = ("record_id", "record_type", "page_id", "url", "payload_digest", "refers_to", "refers_to_record")
    other = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(k, pa.string() if k in text else other[k]) for k in (x.split()[0] for x in RECORD_DDL.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records, size in zip(*(c.to_pylist() for c in batch.columns)):
                held, weight = [], 0
                for r in read_archive(path, records, size, with_payload):
                    held.append(r)
                    weight += 200 + len(r["payload"] or b"")
                    if weight > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    found = written(manifest.select("path", "records", "bytes").repartition(n).mapInArrow(read, RECORD_DDL), "records")
    # what is revisited is counted once a response before it meets the responses
    named = found.filter("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id"), "payload_digest").distinct()
    lost = named.join(found.filter("record_type = 'response'").select("record_id", "payload_digest"),
                      ["record_id", "payload_digest"], "left_anti").first()
    if lost:
        raise WarcError(f"no response {lost['record_id']} with digest {lost['payload_digest']}, which a revisit names")
    return found


def shared_folder(spark, name: str = "warc") -> str:
    """A fresh folder below spark.checkpoint.dir, as a URI."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
