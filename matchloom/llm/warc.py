"""WARC archives: written with one gzip member per record, read sequentially.

An archive is a row (path, content), the shape in which Spark reads binary files: read_archives() takes
spark.read.format("binaryFile") of *.warc.gz files as well as the table that write_archives() makes. An archive is
closed at about archive_bytes, so a row stays small, and each is read on its own: nothing needs an order across rows.

An archive may also be any binary stream: read_records() reads it slice by slice and holds one record, and read_files() does
so for files of any size, each read by one task through its file system.

The reader decompresses a member in slices, parses the header as soon as its empty line has come, takes exactly
Content-Length bytes of block, and checks WARC-Block-Digest and, for a full response, WARC-Payload-Digest, both
SHA-1 in base32. Errors are told in a column, not swallowed: a record with a bad digest or length is returned with
its error, and a broken member ends its archive with a row that says so.

Of records with equal payloads, that with the smallest id is a response; the others are revisits without payload, which
name it. A payload shared by a third of all pages costs one aggregate row and a join that Spark can split.

Cases: null payload: empty. Null id: a record without an id, never first unless all are null. Equal ids with equal
payloads: all are responses. Null url: empty target. Payloads under dedupe_bytes: all responses. Empty table: no archives.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 16


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _from_line(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str, payload: bytes, first: int | None) -> bytes:
    """One gzip member. first: the id that a revisit refers to; None for a full response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response"]
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{first}>"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest) if k}


def members(archive: bytes | BinaryIO) -> Iterator[tuple[bytes, dict[str, str], bytes, str]]:
    """Version line, headers, block and error ('' if none) of each record of an archive."""
    source = io.BytesIO(archive) if isinstance(archive, (bytes, bytearray, memoryview)) else archive
    left = b""
    while left or (left := source.read(SLICE)):
        unpack, got, head, error = zlib.decompressobj(31), bytearray(), -1, ""
        version, fields, need = "", {}, None
        try:
            while not unpack.eof and (part := left or source.read(SLICE)):
                left = b""
                got += unpack.decompress(part)
                if head < 0 and (head := got.find(b"\r\n\r\n")) >= 0:
                    version, fields = _headers(bytes(got[:head]))
                    need = head + 4 + int(fields.get("content-length", "-1"))
            left = unpack.unused_data
        except (zlib.error, ValueError) as e:
            yield b"", {}, b"", f"broken member: {e}"
            return
        if not unpack.eof or head < 0:
            yield b"", {}, bytes(got), "truncated member"
            return
        if not version.startswith("WARC/"):
            error = "no WARC version line"
        elif need is None or need < head + 4 or len(got) != need + 4 or got[need:] != b"\r\n\r\n":
            error = "Content-Length doesn't fit the member"
        yield version.encode(), fields, bytes(got[head + 4 : need]), error


def read_records(archive: bytes | BinaryIO) -> Iterator[dict]:
    for _, fields, block, error in members(archive):
        kind = fields.get("warc-type", "")
        end = block.find(b"\r\n\r\n")
        _, http = _headers(block[:end]) if end >= 0 else ("", {})
        payload = block[end + 4 :] if end >= 0 else block
        size = int(http.get("content-length", len(payload))) if http.get("content-length", "0").isdigit() else -1
        named = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if not error and fields.get("warc-block-digest") not in (None, f"sha1:{digest(block)}"):
            error = "block digest differs"
        if not error and kind == "response" and (named != digest(payload) or size != len(payload)):
            error = "payload digest or length differs"
        number = lambda k: int(x) if (x := fields.get(k, "").removeprefix("<urn:x-page:").removesuffix(">")).lstrip("-").isdigit() else None
        yield {"page_id": number("warc-record-id"), "url": _from_line(fields.get("warc-target-uri", "")), "record_type": kind, "refers_to": number("warc-refers-to"), "payload_bytes": size, "payload_digest": named, "payload": payload if kind == "response" else None, "error": error or None}


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", dedupe_bytes: int = 0, archive_bytes: int = 4 << 20) -> DataFrame:
    """(path, content) archives of a WARC record per page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= dedupe_bytes, F.concat(F.sha1("payload"), F.length("payload").cast("string"))))
    shared = rows.filter("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    rows = rows.join(shared, "digest", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, open_ = TaskContext.get().partitionId(), 0, bytearray()
        row = lambda: pd.DataFrame({"path": [f"part-{task:05d}-{number:05d}.warc.gz"], "content": [bytes(open_)]})
        for batch in batches:
            for page, url, payload, of in zip(batch["page_id"], batch["url"], batch["payload"], batch["first"]):
                page, of = (None if x is None else int(x) for x in (page, of))
                open_ += record(page, url, bytes(payload), None if of is None or of == page else of)
                if len(open_) >= archive_bytes:
                    yield row()
                    number, open_ = number + 1, bytearray()
        if open_:
            yield row()

    # ids pass pandas as strings: a null among integers would make floats of them
    return rows.select(F.col("page_id").cast("string"), "url", "payload", F.col("first").cast("string")).mapInPandas(run, "path string, content binary")


_NAMES = ["path", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "error"]
_SCHEMA = "path string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"


def _frames(path: str, archive: bytes | BinaryIO, payload: bool, held_bytes: int = 8 << 20) -> Iterator[pd.DataFrame]:
    out, held = [], 0
    for r in read_records(archive):
        out.append([path, *(r[k] if payload or k != "payload" else None for k in _NAMES[1:])])
        held += len(r["payload"] or b"") if payload else 0
        if len(out) == 256 or held >= held_bytes:
            yield _frame(out, _NAMES)
            out, held = [], 0
    yield _frame(out, _NAMES)


def read_archives(archives: DataFrame, *, payload: bool = True) -> DataFrame:
    """A row per record: path, page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null without), error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _frames(path, bytes(content), payload)

    return archives.select("path", "content").mapInPandas(run, _SCHEMA)


def read_files(paths: DataFrame, *, path_col: str = "path", payload: bool = True) -> DataFrame:
    """Rows as read_archives() gives them, of files (paths or URIs) that workers open themselves and read in slices."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                files, name = pyarrow.fs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as stream:
                    yield from _frames(path, stream, payload)

    return paths.select(F.col(path_col).alias("path")).mapInPandas(run, _SCHEMA)


def _frame(rows: list[list], names: list[str]) -> pd.DataFrame:
    columns = dict(zip(names, map(list, zip(*rows)) if rows else [[] for _ in names]))
    return pd.DataFrame({c: pd.array(x, "Int64" if c in ("page_id", "refers_to", "payload_bytes") else object) for c, x in columns.items()})
