"""WARC archives: written and read by Spark tasks, one gzip member for each record.

The reader is sequential: it inflates a stream chunk by chunk, a member at a time, cuts the record out by its content
length and verifies the digests of block and payload.  Records whose payload equals one written elsewhere are revisits:
they carry the headers of the response, but no payload.

Archives go through pyarrow's file systems, so the folder may be a path or a URI.  A file's name holds the attempt that
wrote it, and a manifest, kept once the job has ended, names the files that count: what lost or repeated tasks have left
is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col, kept, text_of

LEAST_REVISIT = 1000  # bytes of a payload
FILE_BYTES = 256 << 20
CHUNK = 1 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # of records that were not fetched by this program
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def bare(named: str) -> str:
    """A digest header as lower-case hex digits."""
    return base64.b32decode(named.removeprefix("sha1:")).hex()


def _named(key: str | None) -> str:
    return f"<urn:page:{quote(key or '', safe='')}>"


def _key(named: str) -> str | None:
    return unquote(named.removeprefix("<urn:page:").removesuffix(">")) or None


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member: a response, or a revisit of the response of ``refers_to``."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _named(key)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Refers-To", _named(refers_to)), ("WARC-Profile", PROFILE)]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(lines.encode("utf-8") + block + b"\r\n\r\n") + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]  # names in lower case
    http: dict[str, str]
    payload: bytes


def _headers(lines: bytes) -> dict[str, str]:
    parts = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in parts}


def _parsed(member: bytes) -> Record:
    head, found, rest = member.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = _headers(head)
    length = int(headers["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')} is not framed by its content length")
    if digest(block) != headers.get("warc-block-digest", digest(block)):
        raise ValueError(f"record {headers.get('warc-record-id')} fails its block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    if headers["warc-type"] == "response" and digest(payload) != headers.get("warc-payload-digest", digest(payload)):
        raise ValueError(f"record {headers.get('warc-record-id')} fails its payload digest")
    return Record(headers, _headers(http), payload)


def records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an archive, one after another; no more than one record is held."""
    unpacker, member, raw = zlib.decompressobj(31), bytearray(), stream.read(CHUNK)
    while raw:
        member += unpacker.decompress(raw)
        if unpacker.eof:
            yield _parsed(bytes(member))
            raw, member = unpacker.unused_data or stream.read(CHUNK), bytearray()
            unpacker = zlib.decompressobj(31)
        else:
            raw = stream.read(CHUNK)
            if not raw:
                raise ValueError("archive ends inside a record")


def revisited(pages: DataFrame, id_col: str, html_col: str, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """``key`` of every payload of at least ``least_bytes`` that several rows share, with the largest identifier as ``refers_to``."""
    slim = pages.select(payload_key(pages, html_col).alias("key"), col(id_col).alias("id"), F.octet_length(text_of(pages, html_col)).alias("size"))
    groups = slim.where(F.col("size") >= least_bytes).groupBy("key").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    return kept(groups.where("n > 1").select("key", "refers_to"))


def payload_key(pages: DataFrame, html_col: str) -> Column:
    return F.sha2(text_of(pages, html_col), 256)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for every row; returns the manifest (``path``, ``records``), kept.

    - Null pages have empty payloads.  Rows that repeat an identifier are written one by one; those that hold the largest of
      their payload are all responses.  A null identifier is written as none and revisits like any other.
    - An empty table writes nothing; other columns are not read.
    """
    groups = revisited(pages, id_col, html_col, least_bytes)
    slim = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), text_of(pages, html_col).alias("html"), payload_key(pages, html_col).alias("key"))
    whole = slim.join(groups, "key", "left").select(
        F.col("id").cast("string").alias("id"), "url", "html",
        F.when(~F.col("id").eqNullSafe(F.col("refers_to")), F.col("refers_to").cast("string")).alias("refers_to"),
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = fs.FileSystem.from_uri(folder)
        paths, counts, out, size = [], [], None, 0
        for batch in batches:
            for key, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    paths.append(f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(paths):04d}.warc.gz")
                    counts.append(0)
                    out, size = system.open_output_stream(f"{base}/{paths[-1]}", compression=None), 0
                member = record(key, url, html.encode("utf-8"), refers_to)
                out.write(member)
                counts[-1] += 1
                size += len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], names=["path", "records"])

    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    return kept(whole.mapInArrow(written, "path string, records long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives a manifest names: ``id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Identifiers come back as the strings they were (in the archive all but letters, digits and ``_.-~`` are percent-encoded),
    null where none was written.  Each file is read by one task, record after record.
    """
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, expected in zip(*(c.to_pylist() for c in batch.columns)):
                rows, n = [], 0
                with system.open_input_stream(f"{base}/{path}", compression=None) as stream:
                    for n, r in enumerate(records(stream), 1):
                        h = r.headers
                        refers_to = _key(h["warc-refers-to"]) if "warc-refers-to" in h else None
                        size = len(r.payload) if h["warc-type"] == "response" else int(r.http["content-length"])
                        rows.append((_key(h["warc-record-id"]), h.get("warc-target-uri"), size, bare(h["warc-payload-digest"]), h["warc-type"], refers_to))
                        if len(rows) == 4096:
                            yield _batch(rows, names)
                            rows = []
                if n != expected:
                    raise ValueError(f"{path} holds {n} records, not {expected}")
                if rows:
                    yield _batch(rows, names)

    return manifest.mapInArrow(read, "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for c, n in zip(zip(*rows), names)], names=names)
