"""WARC archives: a Spark writer and a reader that salvages damaged files.

Writing goes through Spark's own text writer, with one record per row, so it works on every store that
Spark writes to and a retried task leaves no half file. Compressed archives have one gzip member per record,
plain ones end each record with its two line breaks.

The reader takes a record only after its checks: the member's checksum, the header, the length, the closing line
breaks and the block digest. After a failed check it looks for the next place where a valid member or version line
begins, goes on from there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import skew_join
from arealis.sources.scratch import materialize, shared_folder

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this are not worth a revisit record.
MIN_REVISIT = 100
DATE = "2020-01-01T00:00:00Z"
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
# The text writer must end rows with something: an empty gzip member adds nothing to the archive.
FEED = 1 << 14  # bytes given to the decompressor at once
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
# A file ends with the record that reaches so many bytes; the reader takes whole files.
FILE_BYTES = 32 << 20
BATCH_BYTES = 8 << 20


def mark_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Add ``_payload, _digest, _refers_to``: null, or the least key that has the same payload.

    The payload is UTF-8, empty for null. A null key never is a response that others refer to, unless no row
    of the payload has a key; rows that repeat the least key are responses all.
    """
    rows = pages.withColumn("_payload", F.coalesce(F.col(payload), F.lit("")).cast("binary"))
    rows = rows.withColumn("_digest", F.sha2("_payload", 256))
    groups = rows.groupBy("_digest", F.octet_length("_payload").alias("_bytes")).agg(
        F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    groups = materialize(groups)
    total = groups.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    copies = groups.filter((F.col("_n") > 1) & (F.col("_bytes") >= min_bytes)).select("_digest", "_first", "_n")
    found = skew_join(rows, materialize(copies), ["_digest"], "_n", total, F.col(key))
    refers = F.when(~F.col(key).eqNullSafe(F.col("_first")), F.col("_first"))
    return found.withColumn("_refers_to", refers).drop("_first", "_n")


def _urn(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    uri = re.sub(r"[\x00-\x20\x7f-\U0010ffff]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url or "")
    lines = [
        "WARC-Type: " + ("revisit" if revisit else "response"),
        f"WARC-Record-ID: {_urn(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block + END


def write_warc(
    pages: DataFrame,
    path: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    compressed: bool = True,
    min_bytes: int = MIN_REVISIT,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write one record per row of ``pages`` and return the folder. Equal payloads are written once.

    A task begins a new file, in a folder of its own, after ``file_bytes`` bytes of records. Rows that repeat are
    records of their own; null keys, urls and payloads are written as empty; other columns are ignored; an empty
    table gives an empty folder.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc"
    marked = mark_revisits(pages.select(key, url, payload), key, payload, min_bytes)
    names = ["key", "url", "payload", "digest", "refers_to"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0

        def packed(rows: Iterator[tuple]) -> Iterator[tuple[bytes, int]]:
            nonlocal written
            for row in rows:
                whole = _record(*row)
                value = gzip.compress(whole, 6, mtime=0) if compressed else whole[: -len(END)]
                yield value, written // file_bytes
                written += len(value)

        for batch in batches:
            rows = zip(*[(v.as_py() for v in batch[name]) for name in names], strict=True)
            yield from _batches(packed(rows), pa.schema([("value", pa.binary()), ("file", pa.int64())]))

    rows = marked.select(key, url, "_payload", "_digest", "_refers_to").toDF(*names)
    rows = rows.mapInArrow(pack, "value binary, file long").withColumn("value", F.col("value").cast("string"))
    writer = rows.write.partitionBy("file").option("encoding", "ISO-8859-1")
    writer.option("lineSep", (EMPTY_MEMBER if compressed else END).decode("latin-1")).text(path)
    return path


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with one large value, in batches of bounded size."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(zip(*held, strict=True), schema, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in columns], schema=schema)

    for row in rows:
        held.append(row)
        size += 200 + max((len(value) for value in row if isinstance(value, bytes)), default=0)
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _parse(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record that begins at ``at`` and the place after it, or the check that failed."""
    line = VERSION_LINE.match(data, at)
    if not line:
        return "no version line"
    stop = data.find(END, line.end() - 2)
    if stop < 0:
        return "header without end"
    fields = {}
    for raw in data[line.end() : stop].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            return "header line without colon"
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        return "no content length"
    begin, finish = stop + 4, stop + 4 + int(length)
    if data[finish : finish + 4] != END:
        return "record without end"
    block = data[begin:finish]
    digest = fields.get(b"warc-block-digest", b"")
    if digest.startswith(b"sha256:") and digest[7:].decode("ascii", "replace") != hashlib.sha256(block).hexdigest():
        return "block digest"
    return {"fields": fields, "block": block}, finish + 4


def _plain(data: bytes, base: int) -> Iterator[tuple]:
    """Records (``offset, record, None``) and gaps (``offset, end, reason``) of uncompressed bytes."""
    at = 0
    while at < len(data):
        found = _parse(data, at)
        if not isinstance(found, str):
            yield base + at, found[0], None
            at = found[1]
            continue
        start = at
        while True:
            line = VERSION_LINE.search(data, at + 1)
            if not line:
                at = len(data)
                break
            at = line.start()
            if not isinstance(_parse(data, at), str):
                break
        yield base + start, base + at, found


def _member(data: bytes, at: int) -> tuple[bytes, int] | None:
    """A whole gzip member whose checksum holds, and the place after it."""
    unzip, out, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not unzip.eof and at < len(data):
            out.append(unzip.decompress(view[at : at + FEED]))
            at += FEED
    except zlib.error:
        return None
    return (b"".join(out), min(at, len(data)) - len(unzip.unused_data)) if unzip.eof else None


def salvage(data: bytes) -> Iterator[tuple]:
    """All records and gaps of an archive's bytes, compressed or plain or both in turn."""
    at = 0
    while at < len(data):
        if data.startswith(MEMBER, at) and (found := _member(data, at)):
            if found[0]:
                inner = list(_plain(found[0], 0))
                for _, record, reason in inner:
                    yield (at, record, None) if reason is None else (at, found[1], reason)
            at = found[1]
            continue
        if VERSION_LINE.match(data, at):
            stop = _next_member(data, at)
            yield from _plain(data[at:stop], at)
            at = stop
            continue
        start, at = at, _next_valid(data, at + 1)
        yield start, at, "gzip member" if data.startswith(MEMBER, start) else "neither member nor version line"


def _next_member(data: bytes, at: int) -> int:
    """Where the next valid gzip member that follows a record's end begins, else the end of the data."""
    while (at := data.find(END + MEMBER, at)) >= 0:
        if _member(data, at + 4):
            return at + 4
        at += 1
    return len(data)


def _next_valid(data: bytes, at: int) -> int:
    """The next place where a valid member or a record begins, else the end of the data."""
    starts = re.compile(re.escape(MEMBER) + rb"|" + VERSION_LINE.pattern)
    while found := starts.search(data, at):
        at = found.start()
        valid = _member(data, at) if data.startswith(MEMBER, at) else not isinstance(_parse(data, at), str)
        if valid:
            return at
        at += 1
    return len(data)


def _key(value: bytes) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", value)
    return int(found[1]) if found else None


ROW = (
    "file string, begin long, end long, reason string, record_type string, page_id long, refers_to long, "
    "url string, payload_digest string, payload_bytes long, payload binary"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives under ``path``.

    A record has a null ``reason``; its ``payload`` is the body after the HTTP head, null for a revisit, whose
    ``payload_bytes`` and ``payload_digest`` are those of the payload it refers to. A gap has the bytes from
    ``begin`` to ``end`` of ``file`` and the check that failed. An empty file gives no rows. Keys are exact at any
    size. Files are read whole, one at a time, so an archive must fit a task's memory and 2 GB; the writer's
    ``file_bytes`` sees to it for all but a file of one larger record.
    """
    schema = spark.createDataFrame([], ROW).toArrow().schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, value in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                found = salvage(value.as_py())
                yield from _batches((_row(file, *entry) for entry in found), schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(read, ROW)


def _row(file: str, begin: int, found, reason: str | None) -> tuple:
    if reason is not None:
        return (file, begin, found, reason, *[None] * 7)
    fields = found["fields"]
    head, _, body = found["block"].partition(END)
    kind = fields.get(b"warc-type", b"").decode("latin-1")
    if kind == "revisit":
        length = re.search(rb"(?i)content-length: *(\d+)", head)
        size, body = int(length[1]) if length else None, None
    else:
        size = len(body)
    digest = fields.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha256:")
    if body is not None:
        digest = hashlib.sha256(body).hexdigest()
    uri = fields.get(b"warc-target-uri", b"").decode("latin-1")
    keys = (_key(fields.get(b"warc-record-id", b"")), _key(fields.get(b"warc-refers-to", b"")))
    return (file, begin, None, None, kind, *keys, uri, digest, size, body)


def records(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNull()).drop("reason", "end")


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log: bytes of each file that belong to no valid record."""
    return read.filter(F.col("reason").isNotNull()).select("file", "begin", "end", "reason")
