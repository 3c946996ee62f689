"""WARC archives (operator 7): writer and salvage reader.

Writing: pages with equal payloads become one response (the smallest key) and
revisits that refer to it. Each record is a gzip member of its own. Spark's text
writer puts the members into files, with an empty gzip member as line separator,
so any store that Spark writes to will do, and a lost task leaves nothing behind.
``gunzip`` reads the files.

Reading: files are loaded whole (their size is bounded by ``records_per_file``)
and walked member by member, or record by record where they aren't compressed.
A record counts only if its header parses, its block is complete and closed, and
its block digest, and the payload digest of a response, agree where the header has
them (digests of unknown algorithms aren't checked). After a failed check the reader
searches for the next gzip member or version line that gives a valid record, goes on
from there, and logs the bytes in between as a gap. A member may hold several records,
and gaps: each has the member's offset and size, and a gap's error says where in the
member's content it is. A member that is cut short or doesn't inflate is a gap whole.

A null payload is an empty one. Equal rows (key and payload) are each written;
among rows of the smallest key all are responses. A null key is written without
one. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit.llm.common import map_slices, stored

#: An empty gzip member: what stands between the records of a file.
SEPARATOR = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
MEMBER, LINE = b"\x1f\x8b\x08", b"WARC/1."
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
CHUNK = 1 << 16

RECORDS = ("file string, offset long, size long, error string, record_type string, key string, payload_bytes long, "
           "payload_digest string, refers_to string, payload binary")


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gzip_member(data: bytes) -> bytes:
    own = zlib.compressobj(6, zlib.DEFLATED, 31)
    return own.compress(data) + own.flush()


def header_safe(value: str) -> str:
    """Control characters and white space as percent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(key: object, uri: str | None, payload: bytes, refers_to: object = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{sha1_32(payload)}", f"WARC-Block-Digest: sha1:{sha1_32(block)}", f"Content-Length: {len(block)}"]
    if key is not None:
        head.append(f"WARC-Record-ID: <urn:x-page:{header_safe(str(key))}>")
    if uri:
        head.append(f"WARC-Target-URI: {header_safe(uri)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{header_safe(str(refers_to))}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Broken(Exception):
    """A check that a record fails."""


def agrees(digest: bytes, data: bytes) -> bool:
    """Whether a digest field, base 32 or hexadecimal, fits the data; unknown algorithms do."""
    algorithm, _, value = digest.decode("ascii", "replace").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return True
    own = hashlib.new(algorithm, data).digest()
    return value.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=") or value.lower() == own.hex()


def page_key(value: bytes | None) -> str | None:
    return value.decode()[len("<urn:x-page:"):-1] if value and value.startswith(b"<urn:x-page:") else None


def parse(data: bytes, at: int = 0) -> tuple[int, dict]:
    """The end of the record at ``at``, and what it holds."""
    if not VERSION.match(data, at):
        raise Broken("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Broken("header not closed")
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        raise Broken("no length")
    start, stop = end + 4, end + 4 + int(length)
    block = data[start:stop]
    if len(block) < int(length) or data[stop:stop + 4] != b"\r\n\r\n":
        raise Broken("block cut short")
    if b"warc-block-digest" in fields and not agrees(fields[b"warc-block-digest"], block):
        raise Broken("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get(b"warc-type", b"").decode("ascii", "replace")
    if kind == "response" and not fields.get(b"content-type", b"application/http").lower().startswith(b"application/http"):
        http, payload = b"", block
    digest = fields.get(b"warc-payload-digest", b"").decode("ascii", "replace").removeprefix("sha1:")
    if kind == "response" and b"warc-payload-digest" not in fields:
        digest = sha1_32(payload)
    elif kind == "response" and not agrees(fields[b"warc-payload-digest"], payload):
        raise Broken("payload digest differs")
    size = re.search(rb"(?im)^content-length: *(\d+)", http)
    return stop + 4, {"record_type": kind, "key": page_key(fields.get(b"warc-record-id")), "payload_digest": digest,
                      "payload_bytes": len(payload) if kind == "response" else int(size[1]) if size else None,
                      "refers_to": page_key(fields.get(b"warc-refers-to")), "payload": payload if kind == "response" else None}


def member_at(data: bytes, at: int) -> tuple[int, bytes]:
    """The end of the gzip member at ``at``, and its content."""
    own, out, end = zlib.decompressobj(31), [], at
    while not own.eof:
        part = data[end:end + CHUNK]
        if not part:
            raise Broken("member cut short")
        try:
            out.append(own.decompress(part))
        except zlib.error as e:
            raise Broken("member doesn't inflate") from e
        end += len(part)
    return end - len(own.unused_data), b"".join(out)


def read_at(data: bytes, at: int, members: bool = True) -> tuple[int, list[tuple[str | None, dict | None]]]:
    """The end of what starts at ``at`` and the (error, record) in it; none for an empty member."""
    if not members or not data.startswith(MEMBER, at):
        end, found = parse(data, at)
        return end, [(None, found)]
    end, content = member_at(data, at)
    if not content:
        return end, []
    inside = list(salvage(content, members=False))
    if not any(found for *_, found in inside):
        raise Broken(inside[0][2])
    return end, [(why and f"{why} (from byte {a} to {a + size} of the member's content)", found) for a, size, why, found in inside]


def next_start(data: bytes, at: int, members: bool = True) -> int:
    places = [p for p in (data.find(MEMBER, at) if members else -1, data.find(LINE, at)) if p >= 0]
    return min(places, default=len(data))


def salvage(data: bytes, members: bool = True) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """(offset, size, error, record) of every record and, with an error instead, of every gap; gzip members only if ``members``."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            end, found = read_at(data, at, members)
        except Broken as e:
            if gap is None:
                gap, why = at, str(e)
            at = next_start(data, at + 1, members)
            continue
        # within a gap only a valid record counts as its end; an empty member may be chance
        if gap is not None and not found:
            at = next_start(data, at + 1, members)
            continue
        if gap is not None:
            yield gap, at - gap, why, None
            gap = None
        for error, one in found:
            yield at, end - at, error, one
        at = end
    if gap is not None:
        yield gap, len(data) - gap, why, None


def with_references(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` (key, uri, body) with ``refers_to``: the smallest key of equal payloads, null for that one."""
    small = pages.select("key", F.sha1("body").alias("digest"), F.octet_length("body").alias("size"))
    same = small.where(F.col("size") >= least_bytes)
    first = same.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).where("n > 1")
    first = stored(first.select("digest", "first"), "equal-payloads")
    later = same.join(first, "digest").where(~F.col("key").eqNullSafe(F.col("first")))
    later = later.groupBy("key").agg(F.collect_set(F.struct("digest", "first")).alias("firsts"))
    keyed = pages.join(later.withColumnRenamed("key", "__key"), F.col("key").eqNullSafe(F.col("__key")), "left").drop("__key")
    own = F.filter("firsts", lambda x: x.digest == F.sha1("body"))
    return keyed.withColumn("refers_to", F.get(own, F.lit(0))["first"]).drop("firsts")


def write_archives(df: DataFrame, path: str, key: str = "page_id", payload: str = "html", uri: str | None = "url",
                   least_bytes: int = 0, records_per_file: int = 1000) -> None:
    """Write one record per row of ``df`` into a new folder. Payloads are text (written as UTF-8) or binary."""
    body = F.col(payload).cast("binary")
    pages = df.select(F.col(key).alias("key"), (F.col(uri) if uri else F.lit(None).cast("string")).alias("uri"),
                      F.coalesce(body, F.lit(b"")).alias("body"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [gzip_member(record(*row)) for row in zip(*(batch.column(c).to_pylist() for c in ("key", "uri", "body", "refers_to")))]
        return pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    members = map_slices(with_references(pages, least_bytes), run, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write.option("maxRecordsPerFile", records_per_file)
     .option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps (``error`` set) of all files under ``path``; columns as in RECORDS."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("record_type", "key", "payload_bytes", "payload_digest", "refers_to", "payload")
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("error", pa.string()), ("record_type", pa.string()),
                            ("key", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                            ("payload", pa.binary())])

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            for file, content in zip(*(batch.column(i) for i in (0, 1))):
                rows, held = [], 0
                for offset, size, error, found in salvage(content.as_py()):
                    row = {"file": file.as_py(), "offset": offset, "size": size, "error": error, **dict.fromkeys(names), **(found or {})}
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 1000 or held >= 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, RECORDS)
