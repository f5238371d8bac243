"""WARC archives: written by Spark's text writer, read back with segments put together.

A record is one line of text output whose line separator is the two line ends that close a WARC record,
so files are committed, retried and compressed as any other Spark output.  Blocks longer than
``segment_bytes`` become a first record and continuation records.  Reading parses files as streams; whole
records are decoded where they are, and only segments are grouped by their origin, put in order, checked
against the stated total length, and then freed of their chunked framing.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, written

# Fixed values of the formats.
LINE_END = "\r\n"
RECORD_END = "\r\n\r\n"
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
CAPTURE_DATE = "2000-01-01T00:00:00Z"
_DIGITS_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DESCRIBED = ["kind", "page_id", "url", "digest", "refers_to"]
PARSED = (
    "kind string, record_id string, page_id long, url string, digest string, refers_to string, origin string,"
    " segment int, total_length long, content binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: each 40 bits are ten hex and eight base32 digits."""
    text = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(text, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), _DIGITS_32, _BASE_32)


def _chunked(data: Column, chunk_bytes: int) -> Column:
    """``data`` as text in chunked transfer framing."""
    count = F.ceil(F.octet_length(data) / F.lit(chunk_bytes)).cast("int")

    def chunk(k: Column) -> Column:
        part = F.substring(data, k * chunk_bytes + 1, F.lit(chunk_bytes))
        return F.concat(F.lower(F.hex(F.octet_length(part).cast("long"))), F.lit(LINE_END), part.cast("string"), F.lit(LINE_END))

    chunks = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), chunk)).otherwise(F.array().cast("array<string>"))
    return F.concat(F.concat_ws("", chunks), F.lit("0" + RECORD_END))


def _record_id(row: Column, segment: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), row.cast("string"), F.lit(":"), segment.cast("string"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL; line ends in a value would end the header and become spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(name + ": "), clean, F.lit(LINE_END)), F.lit(""))


def warc_records(
    pages: DataFrame, smallest_revisit: int = 0, segment_bytes: int = 65_536, chunk_bytes: int = 16_384
) -> DataFrame:
    """The records of ``pages`` (page_id, url, html) as a string column ``value``.

    Of rows whose payloads are equal (by SHA-1) and have at least ``smallest_revisit`` bytes, that with the
    smallest page_id, NULL last, then the first row, is a response; the others revisit it.
    """
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary").alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "row"))
    firsts = rows.groupBy("digest").agg(first["row"].alias("first_row"))
    joined = rows.join(firsts, "digest").withColumn(
        "revisit", (F.col("row") != F.col("first_row")) & (F.octet_length("payload") >= smallest_revisit)
    )
    block = F.concat(F.lit(HTTP_HEAD), F.when(F.col("revisit"), F.lit("")).otherwise(_chunked(F.col("payload"), chunk_bytes)))
    blocks = joined.select("page_id", "url", "row", "digest", "revisit", "first_row", block.cast("binary").alias("block"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("block") / F.lit(segment_bytes)).cast("int"))
    parts = blocks.withColumn("segments", count).withColumn("segment", F.explode(F.sequence(F.lit(1), F.col("segments"))))
    part = F.substring(F.col("block"), (F.col("segment") - 1) * segment_bytes + 1, F.lit(segment_bytes))
    split, later = F.col("segments") > 1, F.col("segment") > 1
    kind = F.when(later, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    head = F.concat(
        F.lit(VERSION.decode() + LINE_END),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", _record_id(F.col("row"), F.col("segment"))),
        _field("WARC-Date", F.lit(CAPTURE_DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("Page-ID", F.when(~later, F.col("page_id"))),
        _field("WARC-Payload-Digest", F.when(~later, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-Profile", F.when(F.col("revisit"), F.lit(IDENTICAL))),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("first_row"), F.lit(1)))),
        _field("WARC-Segment-Number", F.when(split, F.col("segment"))),
        _field("WARC-Segment-Origin-ID", F.when(later, _record_id(F.col("row"), F.lit(1)))),
        _field("WARC-Segment-Total-Length", F.when(split & (F.col("segment") == F.col("segments")), F.octet_length("block"))),
        F.lit("Content-Type: application/http; msgtype=response" + LINE_END),
        _field("Content-Length", F.octet_length(part)),
        F.lit(LINE_END),
    )
    return parts.select(F.concat(head, part.cast("string")).alias("value"))


def write_archives(records: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write ``warc_records`` as gzip files; a file holds at most ``records_per_file`` segments in memory when read."""
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED"
    ).option("maxRecordsPerFile", records_per_file).text(path)


def dechunk(data: bytes) -> bytes:
    """The content of a chunked body; a body that breaks off or is framed wrongly raises."""
    found, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(found)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        found.append(data[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message, without its chunked framing if it has one."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = head.lower().split(b"\r\n")[1:]
    framed = any(f.startswith(b"transfer-encoding:") and b"chunked" in f for f in fields)
    return dechunk(body) if framed and body else body


class _Inflated(io.RawIOBase):
    """Bytes of a file, one or many gzip members or plain, inflated as they are read."""

    def __init__(self, data: bytes):
        self.data, self.at, self.inflater = memoryview(data), 0, None
        self.gzipped = data[:2] == b"\x1f\x8b"

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        size = len(buffer)
        while self.at < len(self.data) or (self.inflater and self.inflater.unconsumed_tail):
            if not self.gzipped:
                got = bytes(self.data[self.at : self.at + size])
                self.at += len(got)
            else:
                if self.inflater is None:
                    self.inflater = zlib.decompressobj(31)
                held = self.inflater.unconsumed_tail
                if not held:
                    held = bytes(self.data[self.at : self.at + 65_536])
                    self.at += len(held)
                got = self.inflater.decompress(held, size)
                if self.inflater.eof:
                    self.at -= len(self.inflater.unused_data)
                    self.inflater = None
            if got:
                buffer[: len(got)] = got
                return len(got)
        return 0


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of a file."""
    stream = io.BufferedReader(_Inflated(data), 1 << 20)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin where the one before ends")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(size := int(fields["content-length"]))
        if len(block) != size:
            raise ValueError("a record breaks off")
        yield fields, block


def _parse_files(segments: bool):
    """Rows of the records in segments, or of the others with their payload."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name.split()[0] for name in PARSED.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for row in range(batch.num_rows):
                found, held = [], 0
                for fields, block in parse_records(batch.column(0)[row].as_py()):
                    number = fields.get("warc-segment-number")
                    if (number is not None) != segments:
                        continue
                    page, total = fields.get("page-id"), fields.get("warc-segment-total-length")
                    found.append(
                        (
                            fields["warc-type"],
                            fields["warc-record-id"],
                            None if page is None else int(page),
                            fields.get("warc-target-uri"),
                            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            fields.get("warc-refers-to"),
                            fields.get("warc-segment-origin-id", fields["warc-record-id"]),
                            None if number is None else int(number),
                            None if total is None else int(total),
                            block if segments else http_payload(block),
                        )
                    )
                    held += len(block)
                    if held > 8 << 20:
                        yield batch_of(found)
                        found, held = [], 0
                if found:
                    yield batch_of(found)

    return parse


def reassemble(segments: DataFrame) -> DataFrame:
    """One row per origin with its ``block``: segments in order of their numbers.

    Of a segment that is there twice one is taken.  A missing segment, a missing total length or a sum of lengths
    that differs from it raises: a block is whole or an error.
    """
    parts = F.sort_array(F.collect_set(F.struct("segment", "content")))
    described = [F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name) for name in DESCRIBED]
    grouped = segments.groupBy("origin").agg(
        *described,
        F.max("total_length").alias("total_length"),
        parts.alias("parts"),
    )
    block = F.concat_ws("", F.transform("parts", lambda p: p["content"].cast("string"))).cast("binary")
    whole = (
        (F.col("parts")[F.size("parts") - 1]["segment"] == F.size("parts"))
        & (F.octet_length("block") == F.col("total_length"))
    )
    wrong = F.raise_error(F.concat(F.lit("segments do not add up: "), F.col("origin"))).cast("binary")
    return grouped.withColumn("block", block).withColumn(
        "block", F.when(F.coalesce(whole, F.lit(False)), F.col("block")).otherwise(wrong)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit under ``path``: record_id, kind, page_id, url, digest, refers_to, payload.

    Record and page ids are those of the archives; the payload of a revisit is empty.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    columns = ["record_id", *DESCRIBED, "payload"]
    whole = files.mapInArrow(_parse_files(False), PARSED).withColumnRenamed("content", "payload").select(*columns)
    joined = reassemble(files.mapInArrow(_parse_files(True), PARSED)).withColumnRenamed("origin", "record_id")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # a long payload at a time
                one = batch.slice(row, 1)
                payload = pa.array([http_payload(one.column(6)[0].as_py())], pa.binary())
                yield pa.RecordBatch.from_arrays([*one.columns[:6], payload], columns)

    decoded = joined.select(*columns[:6], "block").mapInArrow(
        decode, "record_id string, kind string, page_id long, url string, digest string, refers_to string, payload binary"
    )
    return whole.union(decoded)


def archive_pages(pages: DataFrame, smallest_revisit: int = 0, segment_bytes: int = 65_536) -> DataFrame:
    """Write ``pages`` as WARC archives to the shared folder and read them back.

    Returns a row for each row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to (page_id of
    the response).  A NULL html is an empty payload, a NULL page_id stays NULL and is the last to become a
    response, a NULL url is left out; repeated rows revisit the first; an empty table gives an empty one; other
    columns are not looked at.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(warc_records(pages, smallest_revisit, segment_bytes), path)
    read = written(
        read_archives(spark, path).select(
            "record_id",
            "kind",
            "page_id",
            "refers_to",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32_sha1(F.col("payload")).alias("payload_digest"),
        ),
        "captures",
    )
    responses = read.where(F.col("kind") == "response").select(
        F.col("record_id").alias("target"),
        F.col("page_id").alias("target_page"),
        F.col("payload_bytes").alias("target_bytes"),
        F.col("payload_digest").alias("target_digest"),
    )
    revisits = read.where(F.col("kind") == "revisit").join(responses, F.col("refers_to") == F.col("target"))
    return read.where(F.col("kind") == "response").select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).union(revisits.select("page_id", "target_bytes", "target_digest", "kind", "target_page"))
