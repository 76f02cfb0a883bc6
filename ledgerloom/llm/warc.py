"""WARC archives: a writer of one gzip member per record, and a reader that splits files by bytes.

A reading task scans its byte range for the gzip magic, takes a candidate for a member if it decodes
to a WARC header, and owns the records that start inside its range, reading past its end to
finish the last. Files are reached through ``pyarrow.fs``, by the URI of the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, stored, utf8
from ledgerloom.session import new_path

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 256 << 20  # a task begins another file beyond this
RANGE_BYTES = 4 << 20
MOST_TASKS = 16_384
_PIECE = 1 << 18
_PAGE = "urn:page:"
_DATE = "1970-01-01T00:00:00Z"  # the tables carry no time of capture
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None, page_id: int | None) -> str:
    if url is None:
        return f"{_PAGE}{page_id}"
    return "".join(c if c not in "%\r\n\x00" else f"%{ord(c):02X}" for c in url)


def _page(value: str | None) -> int | None:
    name = (value or "").strip("<>").removeprefix(_PAGE)
    return None if name in ("", "None") else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member holding one record; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_PAGE}{page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        f"WARC-No-URL: {url is None}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines[3:3] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_PAGE}{refers_to}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


_FILES = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write every page as a record; gives the table of files (path, bytes, records).

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest page_id is the response and the
    others revisit it; null ids are below all others. Files have names of their own per attempt and
    count only once their task has succeeded, so a repeated or lost task leaves nothing that is read.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = folder or new_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(utf8("html"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= min_bytes).groupBy("key").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("copies")
    )
    # Only payloads that occur again are looked up.
    again = stored(first.where("copies > 1").select("key", "response"), "warc-again")
    placed = rows.join(again, "key", "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    placed = placed.select("page_id", "url", "payload", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit"))

    def task(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, done, path, size, count = None, [], None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, size, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = record(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        columns = list(zip(*done, strict=True)) if done else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _FILES, strict=True)], schema=_FILES)

    files = stored(placed.mapInArrow(task, "path string, bytes bigint, records bigint"), "warc-files")
    scheme = folder.split("://", 1)
    if len(scheme) == 2 and not folder.startswith("file:"):  # a path alone names no store
        host = scheme[1].split("/", 1)[0]
        files = files.withColumn("path", F.concat(F.lit(f"{scheme[0]}://{host}"), "path"))
    return files


def _header(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of the WARC header at the start of ``data`` and its length; None if it is none."""
    if not data.startswith(b"WARC/1."):
        return None
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def members(handle, start: int, end: int) -> Iterator[bytes]:
    """Contents of the gzip members of WARC records that start in [start, end)."""
    at, buffer, base = start, b"", start  # buffer holds the bytes from base on
    while at < end:
        need = at - base
        while len(buffer) - need < len(MAGIC) + 64:
            handle.seek(base + len(buffer))
            more = handle.read(_PIECE)
            if not more:
                break
            buffer += more
        found = buffer.find(MAGIC, need)
        if found < 0:
            at = base + max(need, len(buffer) - len(MAGIC) + 1)
            if len(buffer) - need < len(MAGIC):
                return
            base, buffer = at, buffer[at - base :]
            continue
        at = base + found
        if at >= end:
            return
        unpacker, parts, taken, valid = zlib.decompressobj(31), [], found, None
        try:
            while not unpacker.eof:
                if taken == len(buffer):
                    handle.seek(base + len(buffer))
                    more = handle.read(_PIECE)
                    if not more:
                        raise zlib.error("the file ends inside a member")
                    buffer += more
                step = buffer[taken : taken + _PIECE]
                parts.append(unpacker.decompress(step))
                taken += len(step)
                if valid is None and sum(map(len, parts)) >= 8:
                    valid = b"".join(parts).startswith(b"WARC/1.")
                    if not valid:
                        raise zlib.error("no WARC record")
            taken -= len(unpacker.unused_data)
            content = b"".join(parts)
            if _header(content) is None:
                raise zlib.error("no WARC header")
        except zlib.error:
            if valid:  # a record, but broken: not to be passed over in silence
                raise
            at += 1
        else:
            yield content
            at = base + taken
        buffer, base = buffer[at - base :], at


_READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ]
)


def _parse(content: bytes) -> Iterator[tuple]:
    """The records of one member; a response's payload has to have the digest its header names."""
    while content.strip():
        found = _header(content)
        if found is None:
            raise ValueError("no WARC header")
        fields, at = found
        size = int(fields["content-length"])
        block, content = content[at : at + size], content[at + size + 4 :]
        head, _, payload = block.partition(b"\r\n\r\n")
        http = dict(line.lower().split(b": ", 1) for line in head.split(b"\r\n")[1:])
        own = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and digest(payload) != own:
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
        url = fields.get("warc-target-uri")
        if url is not None and fields.get("warc-no-url") != "True":
            for sign in ("\r", "\n", "\x00", "%"):
                url = url.replace(f"%{ord(sign):02X}", sign)
        else:
            url = None
        yield (
            _page(fields["warc-record-id"]), url, fields["warc-type"], _page(fields.get("warc-refers-to")),
            int(http[b"content-length"]), own, None if revisit else payload,
        )


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the files (path, bytes): ids, url, type, digest, and the payload of responses.

    Files are dealt as ranges of ``range_bytes``, whatever their number and size, to a task each (up to
    ``MOST_TASKS``); empty files give nothing.
    """
    bounded_batches(files.sparkSession)
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.where("bytes > 0").select("path", F.explode(begins).alias("start"), "bytes")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))

    def task(batches):
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as handle:
                    for content in members(handle, start, end):
                        for row in _parse(content):
                            rows.append(row)
                            held += len(row[-1] or b"")
                        if held > _PIECE * 16:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    kind = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
    # By number: merged by size, a thousand ranges would be one task.
    return ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)), "path", "start").mapInArrow(task, kind)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _READ, strict=True)], schema=_READ)
