"""WARC archives as a chunked record table.

Writing: one record per row. A payload beyond the segment size becomes a segmented record, as the WARC
standard has it: a first record and continuation records. Payloads that occur again are revisits.
Reading: archives are streamed block by block; a record becomes rows of (record id, chunk number) with the
bytes so far and the SHA-1 so far, and no record is ever held whole.
"""

from __future__ import annotations

import datetime
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.shared import written

BLOCK = 1 << 20
#: A longer line of a header is an error of the archive.
LINE = 1 << 16
VERSION = "WARC/1.1"


def _field(name: str, value: Column) -> Column:
    """A header line; without a value, none. Line ends inside a value would end the header, so they are coded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(id_: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def records(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 1000, segment: int = BLOCK, date: str | None = None
) -> DataFrame:
    """One column ``record``: each row a WARC record without its last line end, segments of a payload in order.

    A null payload is empty. Of rows with equal payloads of ``least_bytes`` or more, that with the largest id
    is the response and the others are its revisits (rows that share the largest id are responses; if all ids
    are null, all are). A null url gives no target, a null id an empty record name. Payloads are compared by
    length and SHA-1. Only rows of payloads that occur twice find a partner in the join, against a written
    table, so that a payload that a third of all rows share is split.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    plain = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    plain = plain.select("*", F.octet_length("body").cast("long").alias("bytes"), F.sha1("body").alias("digest"))
    copies = written(
        plain.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("digest").alias("d"), F.col("bytes").alias("b"), "first"),
        "warc-copies",
    )
    known = plain.join(copies, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
    revisit = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first")))
    last = F.when(revisit, F.lit(0)).otherwise(F.greatest(F.ceil(F.col("bytes") / segment) - 1, F.lit(0))).cast("int")
    cut = known.withColumn("revisit", revisit).withColumn("last", last).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("last"))))
    chunk = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.substring("body", F.col("k") * segment + 1, F.lit(segment)))
    http = F.when(
        F.col("k") == 0,
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")),
    ).otherwise("")
    kind = F.when(F.col("revisit"), "revisit").when(F.col("k") == 0, "response").otherwise("continuation")
    name, first = _urn(F.col("id")), F.col("k") == 0
    segmented = F.col("last") > 0
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, name).otherwise(_urn(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("segment"), F.col("k") + 1)))),
        _field("WARC-Date", F.lit(date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _urn(F.col("first")))),
        _field("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Segment-Number", F.when(segmented, (F.col("k") + 1).cast("string"))),
        _field("WARC-Segment-Origin-ID", F.when(~first, name)),
        _field("WARC-Segment-Total-Length", F.when(segmented & (F.col("k") == F.col("last")), F.col("bytes").cast("string"))),
        _field("Content-Type", F.when(first, F.lit("application/http;msgtype=response"))),
        _field("Content-Length", (F.octet_length(http) + F.octet_length("part")).cast("string")),
        F.lit("\r\n"), http,
    )
    return cut.withColumn("part", chunk).select(
        F.concat(F.encode(head, "UTF-8"), F.col("part"), F.lit(b"\r\n")).cast("string").alias("record")
    )


def write_archives(rows: DataFrame, path: str, compress: bool = True) -> None:
    """Archives at ``path``, one per partition, written through Spark's commit protocol."""
    rows.write.option("lineSep", "\r\n").option("compression", "gzip" if compress else "none").text(path)


class Stream:
    """Bytes of a file, a block at a time, with all members of a gzip file unpacked."""

    def __init__(self, file, block: int = BLOCK):
        self.file, self.block, self.held, self.at = file, block, b"", 0
        start = file.read(block)
        self.unpack = zlib.decompressobj(31) if start[:2] == b"\x1f\x8b" else None
        self.raw = start
        self.ended = not start

    def _more(self) -> bool:
        """Adds at most about a block to what is held."""
        while not self.ended:
            if self.unpack is None:
                out, self.raw = self.raw, b""
            else:
                if self.unpack.eof:
                    self.raw = self.unpack.unused_data + self.raw
                    self.unpack = zlib.decompressobj(31)
                out = self.unpack.decompress(self.raw, self.block)
                self.raw = self.unpack.unconsumed_tail
                if self.unpack.eof:
                    self.raw = b""
            if not self.raw and not (self.unpack and self.unpack.eof and self.unpack.unused_data):
                self.raw = self.file.read(self.block)
                self.ended = not self.raw
            if out:
                self.held, self.at = self.held[self.at :] + out, 0
                return True
        return False

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.held.find(b"\n", self.at)) < 0:
            if len(self.held) - self.at > LINE:
                raise ValueError("a header line is too long")
            if not self._more():
                rest, self.at = self.held[self.at :], len(self.held)
                return rest or None
        out, self.at = self.held[self.at : end], end + 1
        return out.rstrip(b"\r")

    def take(self, most: int) -> bytes:
        """At least one byte and at most ``most``; empty at the end of the file."""
        if self.at == len(self.held) and not self._more():
            return b""
        out = self.held[self.at : self.at + most]
        self.at += len(out)
        return out


def _headers(stream: Stream) -> tuple[dict[str, str], int]:
    """Named fields up to a blank line, and how many bytes they took at least (with two bytes per line end)."""
    fields, size = {}, 0
    while (line := stream.line()) is not None:
        size += len(line) + 2
        if not line:
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, size


def chunks(stream: Stream, chunk: int = BLOCK) -> Iterator[dict]:
    """The rows of a stream. ``last`` marks the row that ends a record with all its segments."""
    held: dict | None = None
    state, record = None, -1
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields, _ = _headers(stream)
        left, kind = int(fields.get("content-length", 0)), fields.get("warc-type", "")
        goes_on = kind == "continuation" and state is not None and fields.get("warc-segment-origin-id") == state["record_id"]
        if not goes_on:
            if held is not None:
                yield held | {"last": True}
                held = None
            record += 1
            state = {
                "record": record, "record_id": fields.get("warc-record-id"), "record_type": kind, "uri": fields.get("warc-target-uri"),
                "stated_digest": fields.get("warc-payload-digest"), "refers_to": fields.get("warc-refers-to"), "stated_bytes": None,
            }
            sha, number, total = hashlib.sha1(), 0, 0
            if left and "msgtype=" in fields.get("content-type", ""):
                status = stream.line() or b""
                http, size = _headers(stream)
                left -= len(status) + 2 + size
                if "content-length" in http:
                    state["stated_bytes"] = int(http["content-length"])
        while True:
            data = stream.take(min(chunk, left)) if left > 0 else b""
            if left > 0 and not data:
                raise ValueError("the archive ends inside a record")
            left -= len(data)
            total += len(data)
            sha.update(data)
            if data or number == 0:
                if held is not None:
                    yield held | {"last": False}
                held = state | {"chunk": number, "bytes": len(data), "bytes_so_far": total, "sha1_so_far": sha.hexdigest(), "data": data}
                number += 1
            if left <= 0:
                break
    if held is not None:
        yield held | {"last": True}


_SCHEMA = pa.schema([
    ("archive", pa.string()), ("record", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()),
    ("stated_digest", pa.string()), ("stated_bytes", pa.int64()), ("refers_to", pa.string()), ("chunk", pa.int64()), ("bytes", pa.int64()),
    ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_()), ("data", pa.binary()),
])
CHUNK_ROW = (
    "archive string, record long, record_id string, record_type string, uri string, stated_digest string, stated_bytes long, refers_to string, "
    "chunk long, bytes long, bytes_so_far long, sha1_so_far string, last boolean, data binary"
)


def open_stream(uri: str):
    """A file of any store that pyarrow knows, as a stream."""
    if uri.startswith(("file:", "/")):
        return pyarrow.fs.LocalFileSystem().open_input_stream("/" + unquote(uri.removeprefix("file:")).lstrip("/"), compression=None)
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=None)


def read_chunks(spark: SparkSession, path: str, chunk: int = BLOCK, with_data: bool = True) -> DataFrame:
    """The chunked record table (``CHUNK_ROW``) of all archives below ``path``.

    A record without payload is one row of no bytes. ``bytes_so_far`` and ``sha1_so_far`` cover the payload
    up to and with the chunk, over all segments; ``data`` is null if not wanted. A task streams one archive
    after the other and holds a few blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with open_stream(uri) as file:
                    rows: list[dict] = []
                    size = 0
                    for row in chunks(Stream(file), chunk):
                        rows.append(row | {"archive": uri} | ({} if with_data else {"data": None}))
                        size += row["bytes"] if with_data else 0
                        if len(rows) == 1000 or size >= 4 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path")
    return names.mapInArrow(run, CHUNK_ROW)


def record_summary(table: DataFrame, id: str = "page_id") -> DataFrame:
    """One row per record of a chunked record table whose names are ``records``'s: id, size, digest, type, reference.

    What a response has is what was read; a revisit has no payload and states that of its response.
    """
    number = lambda c: F.regexp_extract(c, "<urn:record:(-?[0-9]+)>", 1)
    read = F.col("record_type") == "response"
    return table.where("last").select(
        F.nullif(number(F.col("record_id")), F.lit("")).cast("long").alias(id),
        F.when(read, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(read, F.col("sha1_so_far")).otherwise(F.regexp_replace("stated_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.nullif(number(F.col("refers_to")), F.lit("")).cast("long").alias("refers_to"),
    )
