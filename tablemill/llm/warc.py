"""WARC archives: a distributed writer, and a reader that splits archives by byte ranges.

Writing: one record a gzip member, through Spark's own text sink and so into any store and under its commit protocol.
The sink ends every row with a separator; a NUL separator stands for the last byte of each member, which is the top byte
of the member's length and 0 below 16 MiB. A larger member is followed by an empty member, which ends in 0 as well.

Reading: Spark hands each task byte ranges of the archives, cut at the byte 0x1F with which gzip's magic starts. A task
looks for the magic in its range and tries candidates by decoding them up to a WARC version line. It owns the records
that start in its range and decodes them one after the other. What precedes the first start (a lead) and the last
record, if the range ends within it (an open end), are fragments: a second pass returns only those, and each open end
is put together with the leads that follow it, so no task holds more than a few records.

Payloads are HTTP responses. Of records with equal payloads of at least `least` bytes, the one with the smallest id is a
response, the others are revisits, which carry its id, the digest and the HTTP header, but no payload.

Edge cases: null payloads are empty; null ids and urls are left out of the header and read back as null, and a record
without an id is always a response; rows that share the smallest id are all responses; line breaks in urls are
percent-encoded; an empty table gives an empty archive, which reads as no rows; further columns are ignored. A payload
that itself holds gzipped WARC members, stored uncompressed and cut by a range, is reported as an error, never guessed.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablemill.llm.common import Scratch, read

LEAST, DATE = 100, "2024-01-01T00:00:00Z"
EMPTY = gzip.compress(b"", mtime=0)
MAGIC, PROFILE = b"\x1f\x8b\x08", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(page: int | None, url: str | None, payload: str | None, digest: str, refers: int | None, date: str = DATE) -> bytes:
    body = (payload or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers is not None else http + body
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Date: {date}"]
    if page is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    raw = "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    out = gzip.compress(raw, 6, mtime=0)
    return out if out[-1] == 0 else out + EMPTY


def write_warc(pages: DataFrame, path: str, *, id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> None:
    own = pages.select(F.col(id).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body")).withColumn("digest", F.sha2("body", 256))
    first = own.where(F.octet_length("body") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = own.join(first, "digest", "left").select("page", "url", "body", "digest", F.when(F.col("page") > F.col("first"), F.col("first")).alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([pa.array([member(*r)[:-1] for r in zip(*(c.to_pylist() for c in rows.columns))], pa.binary())], names=["value"])

    known.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


class Members:
    """Decodes gzip members that follow each other in bytes fed piece by piece; holds one member."""

    def __init__(self):
        self.raw, self.out, self.zip, self.left = [], [], None, b""

    def feed(self, data: bytes) -> Iterator[bytes]:
        data = self.left + data
        self.left = b""
        while data:
            if self.zip is None:
                if len(data) < 3:
                    self.left = data
                    return
                if data[:3] != MAGIC:
                    raise ValueError("no gzip member where one must start: the archive is damaged or holds nested archives")
                self.zip, self.raw, self.out = zlib.decompressobj(31), [], []
            self.raw.append(data)
            self.out.append(self.zip.decompress(data))
            if not self.zip.eof:
                return
            data, self.zip = self.zip.unused_data, None
            if record := b"".join(self.out):
                yield record

    def open(self) -> bytes:
        """What is left of a member that has not ended."""
        return b"".join(self.raw) if self.zip is not None else self.left


def starts_record(data: bytes) -> bool | None:
    """Whether gzip bytes decode to a WARC record; None if more bytes are needed to tell."""
    try:
        got = zlib.decompressobj(31).decompress(data, 64)
    except zlib.error:
        return False
    if len(got) >= 7:
        return got.startswith(b"WARC/1.")
    return None if got == b"WARC/1."[: len(got)] else False


class Range:
    """One byte range: what is before its first record, the records that start in it, what it leaves open."""

    def __init__(self, first: bool):
        self.seek, self.held, self.at, self.lead, self.members = not first, bytearray(), 0, b"", Members()

    def feed(self, data: bytes) -> Iterator[bytes]:
        if not self.seek:
            yield from self.members.feed(data)
            return
        self.held += data
        while (at := self.held.find(MAGIC, self.at)) >= 0:
            found = starts_record(bytes(self.held[at : at + 65536]))
            if found is None:
                self.at = at
                return
            if found:
                self.lead, rest, self.seek, self.held = bytes(self.held[:at]), bytes(self.held[at:]), False, bytearray()
                yield from self.members.feed(rest)
                return
            self.at = at + 1
        self.at = max(self.at, len(self.held) - 2)

    def fragments(self) -> tuple[bytes, bytes | None]:
        """Lead, and the open end; None for the latter if no record starts here."""
        return (bytes(self.held), None) if self.seek else (self.lead, self.members.open())


def ranges(batches: Iterator[pa.RecordBatch], records: bool) -> Iterator[tuple]:
    """(file, start, record) for records, or (file, start, lead, open)."""
    key, now = None, None
    for b in batches:
        for file, start, piece in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), b.column("piece").to_pylist()):
            if (file, start) != key:
                if now and not records:
                    yield (*key, *now.fragments())
                key, now, data = (file, start), Range(start == 0), piece if start == 0 else b"\x1f" + piece
            else:
                data = b"\x1f" + piece
            for r in now.feed(data):
                if records:
                    yield (file, start, r)
    if now and not records:
        yield (*key, *now.fragments())


RECORD = "headers map<string,string>, http string, payload binary"
_RECORD = [pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]


def parse(record: bytes) -> tuple[list[tuple[str, str]], str, bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])]
    size = next((int(v) for k, v in headers if k.lower() == "content-length"), 0)
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return headers, http.decode("utf-8", "replace"), payload


def _batch(records: list[bytes]) -> pa.RecordBatch:
    cols = zip(*map(parse, records))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _RECORD)], names=["headers", "http", "payload"])


def _in_batches(records: Iterator[bytes], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= most:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row a record: headers, http (its header, without the blank line) and payload."""
    raw = spark.read.option("lineSep", "\x1f").text(path).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))

    def whole(batches):
        yield from _in_batches(r[2] for r in ranges(batches, True))

    def parts(batches):
        for file, start, lead, rest in ranges(batches, False):
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start]), pa.array([lead], pa.binary()), pa.array([rest], pa.binary())], names=["file", "start", "lead", "rest"])

    cut = raw.mapInArrow(parts, "file long, start long, lead binary, rest binary")
    # an open end belongs to its own range; a lead belongs to the last range before it in which a record starts
    owner = F.last(F.when(F.col("rest").isNotNull(), F.col("start")), ignorenulls=True).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    marked = cut.withColumn("owner", owner)
    ends = marked.where("length(rest) > 0").select("file", F.col("start").alias("owner"), F.col("start").alias("at"), F.col("rest").alias("data"))
    leads = marked.where("length(lead) > 0").select("file", "owner", F.col("start").alias("at"), F.col("lead").alias("data"))
    together = ends.unionByName(leads).repartition(F.col("file"), F.col("owner")).sortWithinPartitions("file", "owner", "at")

    def stitched(batches) -> Iterator[bytes]:
        key, now = None, None
        for b in batches:
            for file, own, data in zip(b.column("file").to_pylist(), b.column("owner").to_pylist(), b.column("data").to_pylist()):
                if (file, own) != key:
                    yield from closed(now)
                    key, now = (file, own), Members()
                yield from now.feed(data)
        yield from closed(now)

    def closed(now: Members | None) -> Iterator[bytes]:
        if now is not None and now.open():
            yield from now.feed(b"\x1f")  # a last byte that is the separator itself is not handed out
            if now.open():
                raise ValueError("a record has no end: the archive is cut off or holds nested archives")

    def joined(batches):
        yield from _in_batches(stitched(batches))

    return raw.mapInArrow(whole, RECORD).unionByName(together.mapInArrow(joined, RECORD))


def digest(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit's payload is known by its headers."""
    h = F.col("headers")
    revisit = h["WARC-Type"] == "revisit"
    return records.select(
        F.expr("try_cast(regexp_extract(headers['WARC-Record-ID'], '<urn:page:(-?[0-9]+)>', 1) as long)").alias("page_id"),
        F.when(revisit, F.regexp_extract("http", r"(?i)content-length: (\d+)", 1).cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_extract(h["WARC-Payload-Digest"], "sha256:([0-9a-f]+)", 1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        h["WARC-Type"].alias("record_type"),
        F.when(revisit, F.regexp_extract(h["WARC-Refers-To"], r"<urn:page:(-?\d+)>", 1).cast("long")).alias("refers_to"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "warc").path("archives")
    write_warc(read(spark, sf_dir, "pages"), path)
    return digest(read_warc(spark, path))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
