"""WARC archives: a writer, and a sequential reader.

One gzip member a record. The reader inflates chunk by chunk, frames each record by its Content-Length and checks the
block and payload digests, so that it holds one record and one chunk at a time. Archives lie in the shared folder, which
executors reach by pyarrow's file systems; a file counts only if the manifest of finished tasks names it, so that a task
that ran twice leaves nothing behind that is read.

Nulls: a null payload is empty, a null page_id is kept as null, a null url becomes `urn:unknown`. Of records with equal
payloads, the one with the least page_id is the response (rows that repeat that page_id too; rows without any page_id if
no row has one), the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, new_path, partitions

CHUNK, PIECE = 1 << 20, 1 << 12
#: A task starts another file beyond so many bytes.
ROLL = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "%" + c.encode("utf-8", "replace").hex() for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """A record as one gzip member. A revisit holds the HTTP head only."""
    digest = sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:uuid:{name}>", "WARC-Date": date, "WARC-Target-URI": _clean(url) if url else "urn:unknown",
        "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{sha1(block)}", "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        fields["WARC-Profile"] = PROFILE
        fields["WARC-Refers-To-Date"] = date
    if refers_to is not None:
        fields["X-Refers-To-Page-ID"] = str(refers_to)
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    fields["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def members(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[bytes]:
    """The inflated bytes of each gzip member, in order."""
    data, at, unpack, parts = b"", 0, None, []
    while True:
        if at >= len(data):
            data, at = stream.read(chunk), 0
            if not data:
                if unpack is not None:
                    raise ValueError("the archive ends inside a record")
                return
        if unpack is None:
            unpack, parts = zlib.decompressobj(31), []
        # A small piece at a time: what a member leaves unused is copied, and there can be many members in a chunk.
        piece = data[at : at + PIECE]
        parts.append(unpack.decompress(piece))
        at += len(piece) - len(unpack.unused_data)
        if unpack.eof:
            unpack = None
            yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(member: bytes) -> dict:
    """One record: its fields (lower case), HTTP head and payload; raises if framing or a digest is wrong."""
    end = member.find(b"\r\n\r\n")
    if not member.startswith(b"WARC/") or end < 0:
        raise ValueError("no WARC head")
    fields = _fields(member[:end])
    n, at = int(fields["content-length"]), end + 4
    if len(member) != at + n + 4 or member[at + n :] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    block = member[at : at + n]
    named = fields.get("warc-block-digest")
    if named is not None and named.startswith("sha1:") and sha1(block) != named.removeprefix("sha1:"):
        raise ValueError("a block differs from its digest")
    split = block.find(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else -1
    http, payload = (_fields(block[:split]), block[split + 4 :]) if split >= 0 else ({}, block)
    kind, size = fields.get("warc-type"), int(http.get("content-length", len(payload)))
    if kind == "response":
        named = fields.get("warc-payload-digest", "")
        # A transfer coding or a length of its own is the server's matter; the digest is of the payload as stored.
        if ("content-length" in http and len(payload) != size) or (named.startswith("sha1:") and sha1(payload) != named.removeprefix("sha1:")):
            raise ValueError("a payload differs from its digest or length")
    return {"fields": fields, "payload": payload, "payload_bytes": size}


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes page_id, url, html under folder; returns the manifest (path, records, bytes) of what was written.
    Payloads shorter than min_bytes are all responses."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    todo = rows.join(first, "digest").select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _fs(folder)
        files.create_dir(root, recursive=True)
        out, name, n, size = None, "", 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n], "bytes": [size]})

        for b in batches:
            for page_id, url, payload, refers_to, again in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = record(page_id, url, payload, refers_to, again)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ROLL:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return materialise(todo.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every record of the archives, one task a few files: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for revisits)."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, records in zip(b.column("path").to_pylist(), b.column("records").to_pylist(), strict=True):
                files, at = _fs(path)
                got, size, n = [], 0, 0
                with files.open_input_stream(at, compression=None) as stream:
                    for member in members(stream):
                        r = parse(member)
                        f, again = r["fields"], r["fields"]["warc-type"] == "revisit"
                        number = lambda k, f=f: int(f[k]) if k in f else None
                        got.append((number("x-page-id"), f.get("warc-target-uri"), f.get("warc-type"), number("x-refers-to-page-id"), r["payload_bytes"], f.get("warc-payload-digest", "").removeprefix("sha1:") or None, None if again else r["payload"]))
                        n, size = n + 1, size + len(r["payload"])
                        if len(got) >= 256 or size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), kinds.values(), strict=True)], names=list(kinds))
                            got, size = [], 0
                if n != records:
                    raise ValueError(f"{path} has {n} records in place of {records}")
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), kinds.values(), strict=True)], names=list(kinds))

    return manifest.select("path", "records").repartition(max(partitions(spark), 1)).mapInArrow(read, "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages to new archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    read = read_archives(spark, write_archives(pages, new_path(spark, "warc")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, 'urn:unknown') AS url FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
s AS (SELECT p.*, first, sha1(p.html) AS h FROM p JOIN f USING (html))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, url
FROM s
"""
