"""WARC archives as a chunked record table.

A payload is cut into chunks of at most ``CHUNK_BYTES`` bytes, between code
points. Each chunk is one WARC record: the first a ``response``, the others ``continuation``
records with their segment number, so that no record is larger than a chunk,
whatever the payload. A page whose payload equals that of a page with a smaller
id becomes a ``revisit`` without payload that names it.

The writer reads a payload twice where it lies, once for its digest and once to hand
on its chunks one by one, so beside the row itself it holds a few chunks, whatever the
payload's size. Spark's text writer makes the files: a row is one record, and the two line
ends after a record are the row separator, so each part file is a plain WARC
stream (gzip over the whole file). Reading goes line by line through Spark's
text reader; a gzip file is read by one task from start to end, so the parser
sees records in file order and holds one chunk at a time, with a running SHA-1
over the chunks of a record. Both work on any store that Spark can reach.

The table read back has one row for each record and chunk number, with payload
length and digest up to and including that chunk.

Defined results: a null html is an empty payload, which is a payload like any
other (the first one is the response of all empty ones); rows with a null id
come after all others; rows that share id and payload are all responses or all
revisits; a null url is left out; line ends in a url are escaped; an empty
table makes no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.marks import keep_marked, mark_table
from tierwise.llm.scratch import Scratch

CHUNK_BYTES = 1 << 16
#: Bytes of records that leave a task together.
BATCH_BYTES = 1 << 20
#: Payloads of at least so many bytes may become revisits.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = 2**63 - 1
_CONTROL = re.compile("[\x00-\x20\x7f]")

CHUNKS = ("record_id string, page_id long, url string, record_type string, refers_to long, "
          "chunk_no int, chunk binary, bytes_so_far long, digest_so_far string, last boolean, "
          "payload_bytes long, payload_digest string")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode().rstrip("=")


def record_id(page: int, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page}/{segment}')}>"


def _payload(html: pa.Scalar) -> memoryview:
    """The bytes of a text where they lie; null reads as empty."""
    return memoryview(html.as_buffer()) if html.is_valid else memoryview(b"")


def payload_chunks(raw: memoryview, size: int) -> Iterator[memoryview]:
    """Parts of at most ``size`` bytes (4 at least), cut between code points; an empty payload has one."""
    at = 0
    while True:
        end = min(at + max(4, size), len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        yield raw[at:end]
        at = end
        if at >= len(raw):
            return


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [_payload(html) for html in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1),
                               pa.array([len(p) for p in payloads], pa.int64()),
                               pa.array([base32(hashlib.sha1(p).digest()) for p in payloads], pa.string())],
                              names=["rid", "page", "size", "digest"])


def _record(kind: str, page: int, segment: int, block: str, size: int, more: list[tuple[str, object]]) -> str:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page, segment)), ("WARC-Date", DATE),
            *more, ("Content-Length", size)]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n" + block


def page_records(page: int, url: str | None, raw: memoryview, refers_to: int | None,
                 chunk_bytes: int = CHUNK_BYTES) -> Iterator[str]:
    """The WARC records of one page, in file order, without their end, each made as it is taken."""
    common = [("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))] if url is not None else []
    common += [("X-Page-Id", page), ("X-Payload-Length", len(raw)),
               ("WARC-Payload-Digest", f"sha1:{base32(hashlib.sha1(raw).digest())}")]
    if refers_to is not None:
        yield _record("revisit", page, 1, "", 0, [
            *common, ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-Id", refers_to),
            ("WARC-Profile", PROFILE)])
        return
    done = 0
    for n, part in enumerate(payload_chunks(raw, chunk_bytes), 1):
        done += len(part)
        more = [("Content-Type", "text/html; charset=utf-8")]
        if n > 1 or done < len(raw):
            more.append(("WARC-Segment-Number", n))
        if n > 1:
            more.append(("WARC-Segment-Origin-ID", record_id(page)))
            if done == len(raw):
                more.append(("WARC-Segment-Total-Length", len(raw)))
        yield _record("response" if n == 1 else "continuation", page, n, str(part, "utf-8"), len(part),
                      [*common, *more])


def _records(chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for page, url, html, refers in zip(*(batch.column(k) for k in (1, 2, 3, 4))):
                for record in page_records(page.as_py(), url.as_py(), _payload(html), refers.as_py(), chunk_bytes):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield pa.record_batch([pa.array(held, pa.string())], names=["value"])
                        held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(held, pa.string())], names=["value"])
    return run


def write_warc(spark: SparkSession, pages: DataFrame, path: str, scratch: Scratch,
               chunk_bytes: int = CHUNK_BYTES, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write (page_id, url, html) rows as gzip WARC files to a new folder."""
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .select(F.xxhash64("page", "html").alias("rid"), "page", "url", "html")
    sums = scratch.save(rows.select("rid", "page", "html").mapInArrow(
        _digests, "rid long, page long, size long, digest string"), "digests")
    first = sums.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size") \
        .agg(F.min("page").alias("refers_to"), F.max("page").alias("last")).where("refers_to < last")
    revisits = scratch.save(sums.join(first, ["digest", "size"]).where("page > refers_to")
                            .select("rid", "refers_to").distinct(), "revisits")
    marks = spark.sparkContext.broadcast(mark_table(revisits.select("rid")))
    schema = "rid long, page long, url string, html string"
    # only pages that may be revisits are shuffled
    alone = rows.mapInArrow(keep_marked(marks, False), schema).withColumn("refers_to", F.lit(None).cast("long"))
    again = rows.mapInArrow(keep_marked(marks), schema).join(revisits, "rid", "left")
    for part in (alone, again):
        (part.select("rid", "page", "url", "html", "refers_to")
         .mapInArrow(_records(chunk_bytes), "value string")
         .write.mode("append").option("compression", "gzip").option("lineSep", RECORD_END).text(path))


class _Parser:
    """Records of one WARC stream, fed line by line (each without its line feed)."""

    def __init__(self, with_payload: bool) -> None:
        self.with_payload = with_payload
        self.left = -1  # payload bytes still to come; -1 in a header or between records
        self.head: dict[str, str] | None = None
        self.block = bytearray()
        self.running, self.total, self.number = hashlib.sha1(), 0, 0

    def feed(self, line: str) -> tuple | None:
        if self.left >= 0:
            raw = line.encode() + b"\n"
            take = raw[:self.left]
            self.block += take
            self.left -= len(take)
            # what follows the payload on its last line is the start of the record's end
            return self._close() if self.left == 0 else None
        text = line.rstrip("\r")
        if self.head is None:
            if text.startswith("WARC/"):
                self.head = {}
            elif text:
                raise ValueError(f"not a WARC header: {text[:80]!r}")
            return None
        if text:
            name, _, value = text.partition(":")
            self.head[name.lower()] = value.strip()
            return None
        self.left = int(self.head["content-length"])
        return self._close() if self.left == 0 else None

    def _close(self) -> tuple:
        head, block = self.head, bytes(self.block)
        self.head, self.left = None, -1
        self.block.clear()
        kind = head["warc-type"]
        if kind != "continuation":
            self.running, self.total, self.number = hashlib.sha1(), 0, 0
        self.running.update(block)
        self.total += len(block)
        self.number += 1
        if int(head.get("warc-segment-number", self.number)) != self.number:
            raise ValueError(f"segment {self.number} missing of page {head['x-page-id']}")
        length, digest = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
        so_far = base32(self.running.digest())
        last = kind == "revisit" or self.total == length
        if last and kind != "revisit" and so_far != digest:
            raise ValueError(f"digest of page {head['x-page-id']} does not match its payload")
        page = int(head["x-page-id"])
        refers = head.get("x-refers-to-page-id")
        return (head.get("warc-segment-origin-id", head["warc-record-id"]),
                None if page == NO_ID else page, head.get("warc-target-uri"),
                "revisit" if kind == "revisit" else "response",
                int(refers) if refers else None, self.number - 1,
                block if self.with_payload else None, self.total, so_far, last, length, digest)


def _parse(with_payload: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(),
             pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsers: dict[str, _Parser] = {}
        for batch in batches:
            rows, size = [], 0
            for line, file in zip(batch.column(0), batch.column(1)):
                name = file.as_py()
                if name not in parsers:
                    parsers = {name: _Parser(with_payload)}
                got = parsers[name].feed(line.as_py())
                if got:
                    rows.append(got)
                    size += len(got[6] or b"")
                    if size > 8 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The chunked record table of the gzip WARC files of a folder."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file")))
    return lines.mapInArrow(_parse(with_payload), CHUNKS)


def page_summary(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record, from its last chunk."""
    return chunks.where("last").select(
        "page_id", F.when(F.col("record_type") == "revisit", F.col("payload_bytes"))
        .otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("payload_digest"))
        .otherwise(F.col("digest_so_far")).alias("payload_digest"), "record_type", "refers_to")
