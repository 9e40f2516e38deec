"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Writing: Spark finds the payloads that occur more than once (by SHA-1 and length); the record with the
largest page id is the response, the others are revisit records that refer to it.  Each task writes
its records, one gzip member per record, into archives of bounded size in the shared folder, under names that
hold the attempt.  Their paths go to a manifest table, not to the driver; only the rows of attempts that Spark commits
are in it, so an attempt that was lost, repeated or overtaken leaves archives that nobody reads, and touches
no other's.

Reading: a task opens an archive, inflates it block by block with zlib (a record is one member; the
bytes after its end begin the next), frames the record by Content-Length, and checks the block's and
the payload's digests.  It holds one record at a time.  A short, long or changed record raises.

Defined results: a null html is an empty payload; payloads under ``revisit_bytes`` are never
revisits; a null page id is smaller than any other, and where all copies have none, all are
responses; rows that repeat the largest page id are all responses; control characters in a URL are
percent-encoded; an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from knnspark.llm.common import pieces, written
from knnspark.session import scratch_path

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file that driver and executors share."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url or str()}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The response record of a page, or, with ``refers_to``, the revisit record."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, url)),
               ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT), ("X-Refers-To-Page-Id", str(refers_to))]
    return member(headers, block)


def with_originals(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): the page whose equal payload is stored in full, if another."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("*", F.sha1("html").alias("sha1"), F.octet_length("html").alias("size"))
    copies = rows.groupBy("sha1", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("n")) \
        .where((F.col("n") > 1) & (F.col("size") >= revisit_bytes)).select("sha1", "size", "original")
    joined = rows.join(written(copies, "warc-copies"), ["sha1", "size"], "left")
    other = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("original")).alias("refers_to"))


def write(pages: DataFrame, folder: str, archive_bytes: int = 32 << 20, revisit_bytes: int = 0,
          date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives and returns their manifest (path, records), written beside them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        context = TaskContext.get()
        out = None
        count = nth = size = 0

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())],
                                              names=["path", "records"])

        for batch in pieces(batches):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{nth:04d}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    info = b"software: page archive writer\r\nformat: WARC File Format 1.1\r\n"
                    size = out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, "", name)),
                                             ("WARC-Date", date), ("WARC-Filename", name),
                                             ("Content-Type", "application/warc-fields")], info))
                    count, nth = 0, nth + 1
                size += out.write(page_member(page_id, url, html.encode(), refers_to, date))
                count += 1
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    rows = with_originals(pages, revisit_bytes)
    return written(rows.mapInArrow(run, "path string, records long"), "warc-manifest")


def records(stream, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a gzip archive, in order, inflated block by block."""
    data = b""
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        unpack, got = zlib.decompressobj(31), []
        while not unpack.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    raise ValueError("the archive ends inside a record")
            got.append(unpack.decompress(data))
            data = unpack.unused_data if unpack.eof else b""
        record = b"".join(got)
        head, blank, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not blank or not lines[0].startswith("WARC/"):
            raise ValueError("a record has no WARC header")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"a block has {len(rest) - 4} bytes; its header says {size}")
        block = rest[:size]
        if "WARC-Block-Digest" in headers and headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"a block of {headers.get('WARC-Record-ID')} doesn't match its digest")
        yield headers, block


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """The row of a response or revisit record, its payload (empty for a revisit) last."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size, digest = int(http["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} doesn't match its digest")
    number = {k: int(headers[k]) if k in headers else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    return (number["X-Page-Id"], headers.get("WARC-Target-URI"), headers["WARC-Type"], size, digest,
            number["X-Refers-To-Page-Id"], payload)


def read(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row for each response and revisit record of the archives that ``manifest.path`` names."""
    schema = RECORD + ", payload binary" * payloads
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[k], types[k]) for k in range(len(names))], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = filesystem(path)
                held, size = [], 0
                with store.open_input_stream(at, compression=None) as stream:
                    for headers, block in records(stream):
                        if headers["WARC-Type"] in ("response", "revisit"):
                            held.append(page_of(headers, block))
                            size += len(block) if payloads else 200
                        if size > 1 << 22:
                            yield batch_of(held)
                            held, size = [], 0
                if held:
                    yield batch_of(held)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(min(archives, 10_000), "path").mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
